"""Distinct rows, precedence between deliveries, unions and metric backfill."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.columns import metric_columns
from panelkit.operators.lookup import require_unique
from panelkit.operators.ranks import with_row_number
from panelkit.operators.skew import (
    BROADCAST_BYTES,
    SLICES,
    HotKeys,
    join_hot_right,
    null_safe_join,
    sized_join,
)
from panelkit.session import side_by_side, stage_sized


def union_all(frames: Iterable[DataFrame], fill: bool = False) -> DataFrame:
    """Stack frames by column name; ``fill`` gives a column some frames lack as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*(columns or df.columns)).distinct()


def distinct_late(
    df: DataFrame, texts: Sequence[Sequence[str]], limit: int = BROADCAST_BYTES, copies: str | None = None
) -> DataFrame:
    """Distinct rows of ``df``, whose ``texts`` are compared and shuffled as numbers and put back after.

    Each group of text columns that belong together is a side table, one row per combination, under a 64-bit number;
    two combinations of one number (one table in millions would have such) are an error, raised in the side table's
    rows. Reads ``df`` once per group. ``copies`` names a column that counts the rows each row stands for.
    """
    numbers = [F.xxhash64(*[x for c in own for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]) for own in texts]
    names = [f"__texts_{i}" for i in range(len(texts))]

    def side(name, number, own):
        combination = F.struct(*own)
        first, last = F.min(combination).alias("first"), F.max(combination).alias("last")
        table = df.select(number.alias(name), *own).distinct().groupBy(name).agg(first, last)
        wrong = F.raise_error(F.lit(f"two texts of one number in {own}"))
        checked = F.when(F.col("first").eqNullSafe(F.col("last")), F.col("first")).otherwise(wrong)
        table, _, measured = stage_sized(table.select(name, checked.alias("texts")).select(name, "texts.*"), "texts")
        return table, measured

    sides = side_by_side(*[lambda x=x: side(*x) for x in zip(names, numbers, texts, strict=True)])
    listed = {c for own in texts for c in own}
    rest = [c for c in df.columns if c not in listed]
    found = df.select(*[n.alias(name) for n, name in zip(numbers, names, strict=True)], *rest)
    found = found.groupBy(*found.columns).agg(F.count("*").alias(copies)) if copies else found.distinct()
    hot = HotKeys(found, *[[name] for name in names])
    for name, (table, measured) in zip(names, sides, strict=True):
        found = sized_join(found, table, [name], limit=limit, measured=measured, hot=hot)
    return found.select(*df.columns, *([copies] if copies else []))


def distinct_without(
    df: DataFrame,
    provenance: str = "file",
    limit: int = BROADCAST_BYTES,
    files: DataFrame | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per content, from the first file in name order; null only where no copy names a file.

    The files are numbered in name order, so the first one is the minimum of a number and found by hashing, combined inside
    each task before the shuffle: content with very many copies is no hot group and nothing is sorted.
    Reads ``df`` twice, the first time only its provenance; ``files`` is a shorter way to that (a table with all of them).
    ``copies`` names a column that counts the rows each row stands for.
    """
    content = [c for c in df.columns if c != provenance]
    files = df if files is None else files
    files = files.select(provenance).filter(F.col(provenance).isNotNull()).distinct()
    files, count, measured = stage_sized(files, "files")
    files = with_row_number(files, [], [provenance], "__number", rows=count)
    numbered = sized_join(df, files, [provenance], limit=limit, measured=2 * measured)
    counted = [F.count("*").alias(copies)] if copies else []
    first = numbered.groupBy(*content).agg(F.min("__number").alias("__number"), *counted)
    found = sized_join(first, files, ["__number"], limit=limit, measured=2 * measured)
    return found.select(*df.columns, *([copies] if copies else []))


#: Bits of a row's place in ``first_by_priority``: its missing metrics and a hash of its content, below the number of its frame.
MISSING_BITS, CONTENT_BITS = 10, 46
MOST_FRAMES = 128


def first_by_priority(
    frames: Sequence[DataFrame], metrics: Sequence[str] | None = None, conflict: str | None = None
) -> DataFrame:
    """Union in which the first frame with a key wins; every non-metric column is key.

    Of rows of one frame that share a key the one with the fewest missing metrics wins, of equally full ones the one
    with the smallest metrics, compared one after the other, null first. ``conflict`` names a column that tells where
    the winning frame holds equally full but different rows of the key.

    Frame, missing metrics and a content hash are packed in one number, and every metric is taken from the row of the
    smallest: a hash aggregation over numbers, combined inside each task before the shuffle. Only the rows of keys in
    conflict are fetched by key and compared metric by metric. Reads the frames twice.
    """
    if len(frames) > MOST_FRAMES:
        raise ValueError(f"more than {MOST_FRAMES} frames")
    united = union_all([df.withColumn("__frame", F.lit(i).cast("long")) for i, df in enumerate(frames)], fill=True)
    names = [c for c in united.columns if c != "__frame"]
    metrics = [c for c in (metrics or metric_columns(united)) if c in names]
    keys = [c for c in names if c not in metrics]
    if not metrics:
        found = united.select(*names).distinct()
        return found.withColumn(conflict, F.lit(False)) if conflict else found
    missing = F.least(sum((F.col(m).isNull().cast("long") for m in metrics), F.lit(0)), F.lit((1 << MISSING_BITS) - 1))
    content = F.xxhash64(*[x for m in metrics for x in (F.col(m).isNull(), F.col(m))]).bitwiseAND((1 << CONTENT_BITS) - 1)

    def place(frame):
        return F.shiftleft(frame, MISSING_BITS + CONTENT_BITS) + F.shiftleft(missing, CONTENT_BITS) + content

    # the smallest place is the winner's; the largest among equally full rows of the winning frame differs in a conflict
    up, down = place(F.col("__frame")), place(F.lit(MOST_FRAMES - 1) - F.col("__frame"))
    emptiness = F.shiftleft(F.lit((1 << MISSING_BITS) - 1) - 2 * missing, CONTENT_BITS)
    ranked = united.withColumn("__place", up).withColumn("__back", down + emptiness)
    picked = [F.min_by(m, "__place").alias(m) for m in metrics]
    best = ranked.groupBy(*keys).agg(*picked, F.min("__place").alias("__low"), F.max("__back").alias("__high"))
    mask = (1 << CONTENT_BITS) - 1
    best = best.withColumn("__conflict", F.col("__low").bitwiseAND(mask) != F.col("__high").bitwiseAND(mask))
    clear = best.filter(~F.col("__conflict")).select(*names, "__conflict")

    class_of = F.shiftright("__place", CONTENT_BITS).alias("__class")
    open_ = best.filter("__conflict").select(*keys, F.shiftright("__low", CONTENT_BITS).alias("__class"))
    # the planner sees at run time how few keys are in conflict, and else cuts up large ones
    rivals = null_safe_join(ranked.select(*names, class_of), open_, [*keys, "__class"], "left_semi")
    least = rivals.groupBy(*keys).agg(F.min(F.struct(*metrics)).alias("__best"))
    settled = least.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in names], F.lit(True).alias("__conflict"))
    found = clear.unionByName(settled)
    return found.withColumnRenamed("__conflict", conflict) if conflict else found.drop("__conflict")


def backfill(
    old: DataFrame,
    new: DataFrame,
    metrics: Sequence[str],
    metric_names: Iterable[str] | None = None,
    validate: bool = True,
    limit: int = BROADCAST_BYTES,
    slices: int = SLICES,
) -> DataFrame:
    """Old rows with ``metrics`` taken from the new rows of the same key.

    The key is every non-metric column both frames have, null equal to null, one old
    row per key. An old row with several new ones appears once for each of them.

    Old rows that repeat a key are an error: at once if the new ones are broadcast, else when the rows are read, since
    the check shares the join's shuffle.
    """
    metric_names = set(metric_names or metric_columns(new)) - set(metrics)
    filled = [m for m in metrics if m in new.columns]
    kept = old.drop(*filled)
    source = new.drop(*metric_names)
    keys = sorted(set(kept.columns) & set(source.columns))
    # Written once, as narrow as it is used; repeated rows only make it larger than what would be broadcast.
    source, _, measured = stage_sized(source, "backfill")
    if measured <= limit:
        if validate:
            require_unique(kept, keys, "old rows")
        joined = null_safe_join(kept, F.broadcast(source.distinct()), keys)
    else:
        joined = join_hot_right(kept, source, keys, slices, validate, distinct=True)
    order = [c for c in old.columns if c in joined.columns]
    return joined.select(*order, *[c for c in joined.columns if c not in order])
