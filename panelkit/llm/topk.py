"""Exact top-k search by exhaustive term-at-a-time accumulation.

Candidates are packed into blocks of postings: for every dimension the rows that have a value
there, and the values. A block of sparse query rows meets every block of candidates once: each
query term scatters its weighted postings into a dense array of scores, a partition selection
takes the k best of each query, and the blocks' results are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import stage_sized

CANDIDATES = 4096
QUERIES = 512
TILE = 64
#: Parts of a block. Whole numbers of any size a component can have are exact as 64-bit floats.
PARTS = {"terms": np.int64, "ends": np.int64, "rows": np.int64, "weights": np.float64, "ids": np.int64}
LARGEST = np.finfo(np.float64).max
BLOCK_SCHEMA = "n long, terms binary, ends binary, rows binary, weights binary, ids binary"


def usable(column: str) -> Column:
    """Vectors that take part: not null and without null or non-finite components."""
    return F.col(column).isNotNull() & F.forall(F.col(column), lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))


def _packer(size: int, scale: float):
    def pack(batches):
        ids, rows, cols, values, n = [], [], [], [], 0

        def block():
            row, col, value = (np.concatenate(x) for x in (rows, cols, values))
            order = np.argsort(col, kind="stable")
            terms, first = np.unique(col[order], return_index=True)
            ends = np.append(first[1:], len(col)).astype(np.int64)
            parts = (terms, ends, row[order], value[order], np.concatenate(ids))
            return pa.RecordBatch.from_pydict(
                {"n": [n]} | {k: [np.ascontiguousarray(x, kind).tobytes()] for (k, kind), x in zip(PARTS.items(), parts, strict=True)}
            )

        for batch in batches:
            vectors = batch.column(1)
            offsets = vectors.offsets.to_numpy().astype(np.int64)
            flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
            numbers = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            done = 0
            while done < len(numbers):
                end = min(len(numbers), done + size - n)
                length = np.diff(offsets[done : end + 1])
                with np.errstate(over="ignore"):
                    value = np.clip(np.floor(scale * flat[offsets[done] : offsets[end]]), -LARGEST, LARGEST)
                some = np.flatnonzero(value)
                rows.append((n + np.repeat(np.arange(len(length)), length))[some])
                first = np.repeat(offsets[done:end] - offsets[done], length)
                cols.append((np.arange(len(value)) - first)[some])
                values.append(value[some])
                ids.append(numbers[done:end])
                n += end - done
                done = end
                if n == size:
                    yield block()
                    ids, rows, cols, values, n = [], [], [], [], 0
        if n:
            yield block()

    return pack


def _unpacked(row: dict, prefix: str):
    return (np.frombuffer(row[prefix + k].as_buffer(), kind) for k, kind in PARTS.items())


def accumulate(terms, ends, rows, weights, n, q_terms, q_ends, q_rows, q_weights, q_n) -> np.ndarray:
    """Integer scores (candidate, query), term at a time.

    The numbers are exact: 32-bit floats, 64-bit floats, 64-bit integers or, where a sum may not fit them, integers without a
    bound; sums that do not fit 64 bits then become the nearest that does.
    """
    top = [int(np.abs(x).max()) if len(x) else 0 for x in (weights, q_weights)]
    bound = top[0] * top[1] * max(1, min(len(terms), len(q_terms)))
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object
    if kind is object:
        weights, q_weights = (np.array([int(w) for w in x], object) for x in (weights, q_weights))
    scores = np.zeros((n, q_n), kind)
    common, mine, theirs = np.intersect1d(terms, q_terms, assume_unique=True, return_indices=True)
    for i, j in zip(mine, theirs, strict=True):
        a, b = (ends[i - 1] if i else 0), ends[i]
        c, d = (q_ends[j - 1] if j else 0), q_ends[j]
        query = np.zeros(q_n, kind)
        query[q_rows[c:d]] = q_weights[c:d]
        weighted = weights[a:b].astype(kind)[:, None] * query[None, :]
        if b - a == n:
            scores += weighted
        else:
            scores[rows[a:b]] += weighted
    return np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64) if kind is object else scores


def best(scores: np.ndarray, ids: np.ndarray, q_ids: np.ndarray, k: int):
    """(query number, candidate number, score) of each query's k best, ties to the smaller id, never itself; rows of one id are one candidate with their best score."""
    order = np.argsort(ids, kind="stable")
    scores, ids = scores[order], ids[order]
    ids, first = np.unique(ids, return_index=True)
    if len(first) < len(scores):
        scores = np.maximum.reduceat(scores, first, axis=0)
    own = ids[:, None] == q_ids[None, :]
    k = min(k + int(own.sum(0).max(initial=0)), len(ids))
    if k < len(ids):
        kth = np.partition(scores, len(ids) - k, axis=0)[len(ids) - k]
    else:
        kth = scores.min(0)
    where_q, where_c = np.nonzero((scores >= kth[None, :]).T & ~own.T)
    value = scores[where_c, where_q]
    # the complement falls as the value rises and, unlike the negative, exists for the smallest integer
    falling = ~value if value.dtype == np.int64 else -value
    rank = np.lexsort((where_c, falling, where_q))
    where_q, where_c, value = where_q[rank], where_c[rank], value[rank]
    place = ragged_rank(where_q)
    take = place < k
    return where_q[take], ids[where_c[take]], value[take]


def ragged_rank(groups: np.ndarray) -> np.ndarray:
    """Place of each element within its run of equal, adjacent group numbers."""
    if not len(groups):
        return groups
    new = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    return np.arange(len(groups)) - np.repeat(new, np.diff(np.append(new, len(groups))))


def _search(k: int):
    def search(batches):
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                row = {name: column[i] for name, column in columns.items()}
                terms, ends, rows, weights, ids = _unpacked(row, "")
                q_terms, q_ends, q_rows, q_weights, q_ids = _unpacked(row, "q_")
                for tile in range(0, len(q_ids), TILE):
                    q_n = min(TILE, len(q_ids) - tile)
                    inside = (q_rows >= tile) & (q_rows < tile + q_n)
                    kept = np.cumsum(inside)[q_ends - 1] if len(q_ends) else q_ends
                    scores = accumulate(terms, ends, rows, weights, len(ids), q_terms, kept, q_rows[inside] - tile, q_weights[inside], q_n)
                    q, c, value = best(scores, ids, q_ids[tile : tile + q_n], k)
                    yield pa.RecordBatch.from_pydict({"query_id": q_ids[tile + q], "vec_id": c, "score": value.astype(np.int64)})

    return search


def top_k(candidates: DataFrame, queries: DataFrame, k: int, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k highest integer inner products of each query row with the candidate rows.

    Components count as floor(``scale`` * x). A row is never its own candidate (rows of its id are
    left out), ties go to the smaller id, and missing components of a shorter vector count as 0.
    Vectors that are null or hold null or non-finite components take no part, nor do null ids;
    empty vectors score 0 with everything. Sums are exact whatever the size of the components; a score beyond 64 bits is told
    as the largest or smallest 64-bit number, and rows with equal told scores tie (a component that ``scale`` takes beyond
    the doubles counts as the largest double). A query id that occurs in several rows gets one list
    over the best scores of all of them. Extra columns are ignored. Returns query_id, rank (from 1), vec_id, score.

    Work is queries x candidates, dealt as one row per pair of blocks; nothing is broadcast.
    """

    def blocks(df, size, prefix):
        rows = df.where(usable(vector) & F.col(id).isNotNull()).select(F.col(id).cast("long"), F.col(vector).cast("array<double>"))
        packed = rows.mapInArrow(_packer(size, scale), BLOCK_SCHEMA)
        return packed.select(*[F.col(c).alias(prefix + c) for c in packed.columns])

    held, count, _ = stage_sized(blocks(candidates, CANDIDATES, ""), "topk-candidates")
    groups = max(1, count)
    asked = blocks(queries, QUERIES, "q_").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = held.withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    pairs = dealt.join(asked.hint("shuffle_merge"), "g").drop("g", "n", "q_n")
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
