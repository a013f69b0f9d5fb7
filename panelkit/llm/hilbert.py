"""Approximate nearest neighbours by shifted space-filling curves.

Every ordering projects the vectors on a few random directions, shifts the grid, and sorts all
vectors by their place on a Hilbert curve, range-partitioned by Spark. A query looks at a window of places
around its own in every ordering; the windows' candidates are merged and ranked again by
cosine. How wide the windows must be is learned: for a bounded sample of queries the true neighbours
are found exactly, and the window is the one that would have caught them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import ranked
from panelkit.llm.topk import best, usable
from panelkit.session import stage

ORDERINGS = 12
DIRECTIONS = 6
BITS = 8
BLOCK = 2048
SAMPLE = 200
CATCH = 0.96


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of grid cells (row, dimension), by Skilling's transformation."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        p = q - one
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    key = np.zeros_like(t)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key


def directions(width: int, ordering: int, count: int = DIRECTIONS) -> tuple[np.ndarray, np.ndarray]:
    """Random orthogonal directions and the grid shift of one ordering, the same in every task."""
    rng = np.random.default_rng(1000 + ordering)
    full = rng.normal(size=(width, max(count, 1)))
    if width >= count:
        full, _ = np.linalg.qr(full)
    return full, rng.random(count)


def places(vectors: np.ndarray, ordering: int) -> np.ndarray:
    """Hilbert keys of unit vectors in one ordering. Components of a projection are scaled to the grid by the normal law."""
    along, shift = directions(vectors.shape[1], ordering)
    z = (vectors @ along) * math.sqrt(max(1, vectors.shape[1]))
    z = np.clip(z / 6 + 0.5, 0, 1 - 1e-9)  # three deviations either way
    cells = np.floor((z + shift) / 2 * 2**BITS).astype(np.int64)
    return hilbert_keys(np.clip(cells, 0, 2**BITS - 1), BITS).astype(np.int64)


def _matrix(column) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1) if raw else np.zeros((0, 0))


def _distinct(vectors: DataFrame, k: int) -> DataFrame:
    """(node, vec, ids): each distinct vector once, with the k + 1 smallest ids that have it.

    Ids of one vector are cut twice, first within groups of about 100,000 ids, so that even a vector
    that most rows share fills no task.
    """
    salts = max(1, math.ceil(vectors.count() / 100_000))
    part = vectors.groupBy("vec", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")).agg(F.slice(F.sort_array(F.collect_set("id")), 1, k + 1).alias("ids"))
    whole = part.groupBy("vec").agg(F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    return whole.select(F.col("ids")[0].alias("node"), "vec", "ids")


def _even(v: np.ndarray, width: int) -> np.ndarray:
    """The vector at full width, and scaled by a power of two so that its largest component is from 1/2 to 1: squares neither overflow nor vanish."""
    exponent = int(np.frexp(np.abs(v).max())[1])
    # in two steps: the power itself may be beyond the range of a double
    scaled = np.ldexp(np.ldexp(v, -(exponent // 2)), exponent // 2 - exponent)
    return np.append(scaled, np.zeros(width - len(v))) + 0.0


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of a with those of b, in double precision."""
    return (a @ b.T) / np.sqrt((a * a).sum(1))[:, None] / np.sqrt((b * b).sum(1))[None, :]


def _nearest(k: int, queries: np.ndarray, names: np.ndarray):
    """Exact neighbours of a few queries within each batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = cosines(_matrix(batch.column(1)), queries)
                q, c, s = best(score, batch.column(0).to_numpy(), names, k)
                yield pa.RecordBatch.from_pydict({"query": names[q], "node": c, "score": s})

    return run


def _keys(orderings: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1))
            unit = v / np.sqrt((v * v).sum(1))[:, None]
            for o in range(orderings):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), o, np.int32)), pa.array(places(unit, o)), batch.column(0), batch.column(1)], names=["o", "key", "node", "vec"])

    return run


def _search(k: int, window: int):
    def run(key, mine: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query": [], "node": [], "score": []}
        if mine.num_rows and asked.num_rows:
            place = mine.column("place").to_numpy()
            order = np.argsort(place)
            place, v, names = place[order], _matrix(mine.column("vec"))[order], mine.column("node").to_numpy()[order]
            at, qv, qn = asked.column("place").to_numpy(), _matrix(asked.column("vec")), asked.column("node").to_numpy()
            for first in range(0, len(qn), 256):
                part = slice(first, first + 256)
                score = cosines(v, qv[part])
                score[np.abs(place[:, None] - at[None, part]) > window] = -np.inf
                q, c, s = best(score, names, qn[part], k)
                real = s > -np.inf
                out["query"].append(qn[part][q[real]])
                out["node"].append(c[real])
                out["score"].append(s[real])
        cat = {n: np.concatenate(x) if x else np.zeros(0) for n, x in out.items()}
        return pa.table({"query": pa.array(cat["query"], pa.int64()), "node": pa.array(cat["node"], pa.int64()), "score": pa.array(cat["score"], pa.float64())})

    return run


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "embedding", orderings: int = ORDERINGS, sample: int = SAMPLE, catch: float = CATCH) -> DataFrame:
    """The k rows of largest cosine found for each query row: query_id, rank (from 1), vec_id, score.

    A query is never its own neighbour, ties go to the smaller id. Vectors that are null, zero or hold null or
    non-finite components take no part, nor do null ids; missing components of a shorter vector count as 0.
    Very large and very small vectors are scaled by a power of two first, which no cosine feels. Equal vectors stand in the index once, with as many ids as an answer
    can need, so copies cost nothing. ``queries`` must be rows of ``vectors``. Repeated rows count once. Extra columns are ignored.

    ``sample`` queries (lowest id hash) are answered exactly to find the window that catches the share ``catch``
    of their neighbours; all rows are in the index.
    """

    plain = vectors.where(usable(vector) & F.col(id).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.exists("v", lambda x: x != 0))
    width = plain.agg(F.max(F.size("v"))).first()[0] or 0

    def packed(batches):
        for batch in batches:
            raw = [_even(np.asarray(x, np.float64), width).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "vec"])

    rows = stage(plain.withColumn("v", F.transform("v", lambda x: x + 0.0)).mapInArrow(packed, "id bigint, vec binary"), "curve-rows")
    index = stage(_distinct(rows, k), "curve-distinct")
    asked = rows.join(queries.select(F.col(id).cast("long").alias("id")).distinct(), "id").join(index.select("node", "vec", "ids"), "vec").select("id", "node", "ids", "vec").distinct()
    asked = stage(asked, "curve-asked")
    placed = ranked(index.select("node", "vec").mapInArrow(_keys(orderings), "o int, key bigint, node bigint, vec binary"), ["o", "key", "node"], "row", "curve-places")
    total = index.count()
    placed = placed.withColumn("place", F.col("row") - F.col("o") * F.lit(total))

    trial = asked.select("node", "vec").distinct().orderBy(F.xxhash64("node"), "node").limit(sample).collect()
    window = total
    if trial:
        names = np.array([r[0] for r in trial])
        near = index.select("node", "vec").mapInArrow(_nearest(k, _matrix(pa.array([bytes(r[1]) for r in trial], pa.binary())), names), "query bigint, node bigint, score double")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
        truth = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("query", "node")
        where = placed.select("o", "node", "place").join(F.broadcast(truth.select("node").union(truth.select("query")).distinct()), "node")
        where = stage(where, "curve-trial")
        a = where.select("o", F.col("node").alias("query"), F.col("place").alias("pq"))
        gaps = [r[0] for r in truth.join(where, "node").join(a, ["o", "query"]).groupBy("query", "node").agg(F.min(F.abs(F.col("place") - F.col("pq"))).alias("gap")).select("gap").collect()]
        if gaps:
            window = max(4 * k, int(np.quantile(gaps, catch)) + 1)

    block = lambda c: F.floor(c / BLOCK).cast("long")
    held = placed.select("o", "node", "vec", "place", block(F.col("place")).alias("block"))
    ends = (F.greatest(F.lit(0), F.col("place") - window), F.least(F.lit(total - 1), F.col("place") + window))
    here = placed.join(asked.select("node").distinct(), "node").select("o", "node", "vec", "place", F.explode(F.sequence(block(ends[0]), block(ends[1]))).alias("block"))
    here = stage(here, "curve-windows")
    found = held.groupBy("o", "block").cogroup(here.groupBy("o", "block")).applyInArrow(_search(k, window), "query bigint, node bigint, score double")
    found = found.groupBy("query", "node").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    top = stage(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select(F.col("query").alias("from"), F.col("node").alias("to")), "curve-found")
    # the distinct vectors found, and the query's own; then every id they stand for
    pairs = top.unionByName(asked.select(F.col("node").alias("from"), F.col("node").alias("to"))).distinct()
    target = index.select(F.col("node").alias("to"), F.col("vec").alias("tv"), F.col("ids").alias("tids"))
    source = index.select(F.col("node").alias("from"), F.col("vec").alias("fv"))

    def rerank(batches):
        for batch in batches:
            a, b = _matrix(batch.column(1)), _matrix(batch.column(3))
            score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1))) if len(a) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score)], names=["from", "tids", "score"])

    scored = pairs.join(target, "to").join(source, "from").select("from", "fv", "tids", "tv").mapInArrow(rerank, "from bigint, tids array<bigint>, score double")
    answers = scored.select("from", "score", F.explode("tids").alias("vec_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = answers.withColumn("p", F.row_number().over(Window.partitionBy("from").orderBy(F.desc("score"), "vec_id"))).where(F.col("p") <= k + 1)
    result = asked.select(F.col("id").alias("query_id"), F.col("node").alias("from")).join(answers, "from").where("query_id <> vec_id")
    return result.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


