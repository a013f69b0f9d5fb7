"""Shared pieces of the text operators: folds, labels, texts as byte arrays, hashes, ranks, components.

Texts come to Python as Arrow batches. Their bytes are handled as one numpy array per block of
whole texts, so that counting and hashing run over all words of many documents at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.session import stage, unstage

BLOCK_BYTES = 1 << 21

_rng = np.random.default_rng(20250101)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_powers = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True


def fold(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def held_out(n: int, rest: int, column: str = "doc_id") -> Column:
    """True for rows set apart from learning; a null id is never set apart."""
    return F.coalesce(fold(n, column) == rest, F.lit(False))


def usable_labels(labels: DataFrame, label: str, n: int, rest: int) -> DataFrame:
    """(doc_id, label) of all labelled ids outside the held-out fold.

    Null ids and null labels are left out; an id with several labels gets their majority.
    """
    return (
        labels.select("doc_id", F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(n, rest))
        .groupBy("doc_id")
        .agg(F.when(F.avg("label") >= 0.5, 1).otherwise(0).alias("label"))
    )


def label_sample(labels: DataFrame, label: str, n: int, rest: int, bound: int) -> DataFrame:
    """At most ``bound`` of the ``usable_labels``, lowest hash of the id first."""
    return usable_labels(labels, label, n, rest).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text begins; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(column, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive blocks of whole texts."""
    data, offsets = text_bytes(column)
    first = 0
    while first < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = max(end, first + 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of ``member`` that stays within a text."""
    start = member.copy()
    start[1:] &= ~member[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = member[first]
    end = member.copy()
    end[:-1] &= ~member[1:] | start[1:]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finishing step of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("n", 0) < n:
        size = max(n, BLOCK_BYTES + 1)
        up, down = np.full(size, BASE), np.full(size, BASE_INVERSE)
        up[0] = down[0] = 1
        _powers.update(n=size, up=np.cumprod(up), down=np.cumprod(down))
    return _powers["up"], _powers["down"]


def running_hash(codes: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hashes`` reads the hash of any span."""
    up, _ = _power_table(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal content gives equal hashes wherever it stands."""
    _, down = _power_table(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Finder:
    """Positions of 64-bit keys in a fixed set, by one table access for nearly all keys."""

    def __init__(self, keys: np.ndarray, spare_bits: int = 3):
        """``keys``: sorted and distinct."""
        self.keys = keys
        bits = max(4, int(len(keys)).bit_length() + spare_bits)
        self.shift = np.uint64(64 - bits)
        self.slot = np.full(1 << bits, -1, np.int32)
        if len(keys):
            self.slot[self._home(keys)] = np.arange(len(keys), dtype=np.int32)

    def _home(self, keys):
        return ((keys * BASE) >> self.shift).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The index of each key, -1 where it is not in the set."""
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int64)
        at = self.slot[self._home(wanted)].astype(np.int64)
        lost = np.flatnonzero((at >= 0) & (self.keys[at] != wanted))
        if len(lost):
            again = np.minimum(np.searchsorted(self.keys, wanted[lost]), len(self.keys) - 1)
            at[lost] = np.where(self.keys[again] == wanted[lost], again, -1)
        return at


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of the runs of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def list_array(values: np.ndarray, width: int, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as an Arrow list column."""
    flat = np.ascontiguousarray(values).reshape(-1)
    at = np.arange(0, len(flat) + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat, kind))


def ranked(df: DataFrame, order: list[str], rank: str, name: str, pieces: int | None = None) -> DataFrame:
    """Number all rows from 0 in the given order, which must be a total one.

    Rows are sorted by range and written once; only the row count of each piece goes to the driver. ``unstage`` takes the result.
    """
    spark = df.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(pieces, *order).sortWithinPartitions(*order)
    staged = stage(ordered.withColumn("__row", F.monotonically_increasing_id()), name)
    part = F.shiftright("__row", 33)
    counts = sorted(tuple(r) for r in staged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    offset = spark.createDataFrame(offsets, "__p long, __offset long")
    found = (
        staged.join(F.broadcast(offset), part == F.col("__p"))
        .withColumn(rank, F.col("__offset") + F.col("__row").bitwiseAND((1 << 33) - 1))
        .drop("__row", "__p", "__offset")
    )
    found.staged_path = staged.staged_path
    return found


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, root) of every vertex of ``links`` (a, b): root is the smallest id it is linked with.

    Every root hooks onto its smallest neighbour, chains are halved until flat, links are
    relabelled, and so on while links between different roots remain. Every step is a
    written table, so a lost executor costs one step at most.
    """
    links = stage(links.where("a <> b").distinct(), name)
    found = None
    while not links.isEmpty():
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stage(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root")), name)
        while True:
            up = hook.select(F.col("id").alias("root"), F.col("root").alias("above"))
            jumped = stage(hook.select("id", "root").join(up, "root").select("id", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), name)
            unstage(hook)
            hook, flat = jumped, jumped.where("moved").isEmpty()
            if flat:
                break
        roots = hook.select("id", "root")
        if found is None:
            longer = stage(roots, name)
        else:
            up = roots.select(F.col("id").alias("root"), F.col("root").alias("above"))
            longer = stage(found.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root")), name)
            unstage(found)
        found = longer
        a = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        left = stage(links.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), name)
        unstage(hook, links)
        links = left
    if found is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return found
