"""Left joins that hold up when one key carries a large part of the rows.

The side that repeats a key is cut into pieces for the hot keys only, and the other
side's rows of those keys are copied once per piece. A hot key is one with more than
``1/SLICES`` of the rows, so there are fewer than ``SLICES`` of them whatever the data,
which bounds both the broadcast list of hot keys and the copies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

from panelkit.session import row_bytes, stage

SLICES = 10_000
#: Entries of a frequent-items sketch (its error is 3.5 / entries of the rows), keys listed, and groups in which sketches are combined.
TRACKED, LISTED, GROUPS = 1 << 16, 10_000, 200
BROADCAST_BYTES = 64 * 1024 * 1024


def size(df: DataFrame) -> int:
    """Bytes of a table, in one pass."""
    return int(df.agg(F.sum(row_bytes(df))).first()[0] or 0)


def profile(df: DataFrame, keys: Sequence[str]) -> tuple[int, int, int]:
    """Rows, bytes and the most rows of one key, in one pass that combines before the shuffle."""
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("__rows"), F.sum(row_bytes(df)).alias("__bytes")
    )
    found = per_key.agg(F.sum("__rows"), F.sum("__bytes"), F.max("__rows")).first()
    return tuple(int(v or 0) for v in found)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which a null key meets a null key; the keys come from the left."""
    renamed = {k: f"__right_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(renamed)
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys])
    joined = left.join(right, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())


def spread(df: DataFrame) -> Column:
    """A number that spreads the rows of one key.

    Task number plus row hash spreads exact copies as well as distinct rows, and a
    task that is run again after a lost executor gives every row the same number.
    """
    return F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) + F.spark_partition_id()


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """A number for the key of a row; integers of all widths give the same one."""
    whole = [df.schema[k].dataType for k in keys]
    return F.xxhash64(*[F.col(f"`{k}`").cast("long") if isinstance(t, IntegralType) else F.col(f"`{k}`") for k, t in zip(keys, whole, strict=True)])


class HotKeys:
    """The hot keys of one table for all the lookups to come, found in one pass when the first join asks.

    Every task keeps a frequent-items sketch of each key's hash, the sketches are combined in groups and then as
    a whole. A sketch has at most ``TRACKED`` entries whatever the data, and misses no key with more than ``1/SLICES``
    of the rows. A key that shares its hash with a hot one is cut up as well, which costs a few copies and changes no row.
    """

    def __init__(self, df: DataFrame, *key_sets: Sequence[str], slices: int = SLICES):
        self.df, self.key_sets, self.slices = df, [tuple(k) for k in key_sets], slices
        self._found: dict[tuple, dict[int, int]] | None = None

    def __contains__(self, keys: Sequence[str]) -> bool:
        return tuple(keys) in self.key_sets

    def pieces(self, keys: Sequence[str]) -> dict[int, int]:
        """Hash of each hot key and the number of pieces to cut it into; at most ``LISTED`` of them."""
        if self._found is None:
            self._found = self._find()
        return self._found[tuple(keys)]

    def _find(self) -> dict[tuple, dict[int, int]]:
        hashed = self.df.select(*[key_hash(self.df, keys).alias(f"k{i}") for i, keys in enumerate(self.key_sets)])
        part = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("part")
        sketches = [F.expr(f"approx_top_k_accumulate(k{i}, {TRACKED})").alias(f"s{i}") for i in range(len(self.key_sets))]
        grouped = hashed.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), *sketches)
        best = [F.expr(f"approx_top_k_estimate(approx_top_k_combine(s{i}, {TRACKED}), {LISTED})") for i in range(len(self.key_sets))]
        total, *found = grouped.agg(F.sum("rows"), *best).first()
        return {
            keys: {r["item"]: min(r["count"], -(-r["count"] * self.slices // total)) for r in rows or [] if r["count"] > max(1, total // self.slices)}
            for keys, rows in zip(self.key_sets, found, strict=True)
        }


def hot_keys(df: DataFrame, keys: Sequence[str], slices: int = SLICES) -> dict[int, int]:
    """Hashes of the keys with more than ``1/slices`` of the rows, and the pieces to cut each into."""
    return HotKeys(df, keys, slices=slices).pieces(keys)


def named(df: DataFrame, hot: Mapping[int, int], keys: Sequence[str]) -> DataFrame:
    """The hot keys themselves with their pieces: the keys of ``df`` whose hashes are hot."""
    flagged = _flagged(df.select(*keys), hot, keys).filter(F.col("__pieces").isNotNull())
    return stage(flagged.groupBy(*keys).agg(F.max("__pieces").alias("__pieces")), "hot-keys")


def _flagged(df: DataFrame, hot: Mapping[int, int] | DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the number of pieces of their key, null for the others."""
    if isinstance(hot, DataFrame):
        return null_safe_join(df, F.broadcast(hot), keys)
    table = df.sparkSession.createDataFrame(sorted(hot.items()), "__key long, __pieces int")
    return df.withColumn("__key", key_hash(df, keys)).join(F.broadcast(table), "__key", "left").drop("__key")


def _cut(df: DataFrame, hot: Mapping[int, int] | DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number the piece of every row."""
    piece = F.coalesce(F.pmod(spread(df), F.col("__pieces")), F.lit(0))
    return _flagged(df, hot, keys).withColumn("__piece", piece.cast("int")).drop("__pieces")


def _copy(df: DataFrame, hot: Mapping[int, int] | DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per piece of the row's key."""
    last = F.coalesce(F.col("__pieces"), F.lit(1)) - 1
    return _flagged(df, hot, keys).withColumn("__piece", F.explode(F.sequence(F.lit(0), last)))


def _same_kinds(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with keys of one type, so that equal keys have equal hashes; integers may differ in width."""
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if a != b and not (isinstance(a, IntegralType) and isinstance(b, IntegralType)):
            kind = left.select(k).union(right.select(k)).schema[k].dataType
            left, right = left.withColumn(k, F.col(f"`{k}`").cast(kind)), right.withColumn(k, F.col(f"`{k}`").cast(kind))
    return left, right


def join_hot_left(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    slices: int = SLICES,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Left or inner join when the left side repeats keys; ``hot`` are its ``hot_keys`` if known."""
    left, right = _same_kinds(left, right, keys)
    hot = hot_keys(left, keys, slices) if hot is None else hot
    if not hot:
        return null_safe_join(left, right, keys, how)
    copies = _copy(right, hot, keys).drop("__pieces")
    joined = null_safe_join(_cut(left, hot, keys), copies, [*keys, "__piece"], how)
    return joined.drop("__piece")


def join_hot_right(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    slices: int = SLICES,
    unique: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """Left join with ``right``, a table to be read twice, when that side repeats keys.

    Each side is shuffled once, by key and piece; the ``distinct`` of the right rows, the check that ``unique`` asks for (one
    left row per key, else an error in the rows) and the join all use that shuffle. For a distinct the piece of a right row follows
    from its content, so that copies meet. Every copy of a hot left row has its match in at least one piece, because the key itself is among the
    right keys; copies whose piece has none are dropped.
    """
    left, right = _same_kinds(left, right, keys)
    hot = hot_keys(right, keys, slices)
    values = [c for c in right.columns if c not in keys]
    if hot:
        exact = named(right, hot, keys)
        left = _copy(left, exact, keys)
        content = F.xxhash64(*[x for c in values for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]) if values else F.lit(0)
        place = F.pmod(content if distinct else spread(right), F.col("__pieces"))
        right = _flagged(right, exact, keys).withColumn("__piece", F.coalesce(place, F.lit(0)).cast("int"))
    else:
        left = left.withColumn("__pieces", F.lit(None).cast("int"))
    # one key that is never null: fields of a struct that are null equal each other
    kinds = left.select(*keys).union(right.select(*keys)).schema
    kind = StructType([StructField(f.name, f.dataType) for f in kinds])
    key, place = F.struct(*keys).cast(kind), ["__key", "__piece"] if hot else ["__key"]
    right = right.withColumn("__key", key).select(*place, *values).repartition(*place)
    right = (right.distinct() if distinct else right).withColumn("__matched", F.lit(True))
    left = left.withColumn("__key", key).repartition(*place)
    if unique:
        count = F.count(F.lit(1)).over(Window.partitionBy(*place))
        wrong = F.raise_error(F.concat(F.lit(f"{', '.join(keys)} repeats: "), F.to_json("__key")))
        left = left.withColumn("__pieces", F.when(count > 1, wrong.cast("int")).otherwise(F.col("__pieces")))
    joined = left.join(right, place, "left")
    kept = joined.filter(F.col("__pieces").isNull() | F.col("__matched").isNotNull())
    return kept.drop("__key", "__pieces", "__piece", "__matched")


def sized_join(
    df: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    measured: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Broadcast ``side`` if its measured bytes allow, else join with hot keys cut up.

    ``hot`` knows the hot keys of the table that ``df`` was made from; without it ``df`` is read for them.
    """
    if (size(side) if measured is None else measured) <= limit:
        return null_safe_join(df, F.broadcast(side), keys, how)
    hot = hot.pieces(keys) if hot is not None and keys in hot else None
    if how in ("left_semi", "left_anti"):
        marked = side.select(*keys).distinct().withColumn("__hit", F.lit(True))
        joined = join_hot_left(df, marked, keys, hot=hot)
        hit = F.col("__hit").isNotNull()
        return joined.filter(hit if how == "left_semi" else ~hit).drop("__hit")
    return join_hot_left(df, side, keys, how, hot=hot)
