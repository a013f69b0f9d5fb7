"""Row numbers and dense ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.skew import SLICES, null_safe_join, sized_join
from panelkit.session import stage, stage_sized

ONE_TASK_ROWS = 1_000_000


def with_row_number(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    to: str,
    one_task_rows: int = ONE_TASK_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Number the rows of every ``by`` group from 1 in ``order``; rows of one order value go by a hash of their content.

    A table of at most ``one_task_rows`` rows (counted unless ``rows`` tells) uses a plain window, which then cannot meet
    a larger group. In a larger table the groups with more rows than that (or than ``1/SLICES`` of all, so that they are
    fewer than ``SLICES``) are sorted by range, which lays them across many partitions, and written with the index that
    each row has in its partition. Where a group begins in a partition and how many of its rows lie before are then
    joined by broadcast, at most one row for each such group and partition border: after the write no row is
    shuffled again. All other groups use the plain window.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    content = F.xxhash64(*[x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])

    def plain(frame):
        window = Window.partitionBy(*by).orderBy(*order, content)
        return frame.withColumn(to, F.row_number().over(window).cast("long"))

    total = df.count() if rows is None else rows
    if total <= one_task_rows:
        return plain(df)
    most = max(one_task_rows, total // SLICES)
    if not by:
        return _numbered_by_range(df, by, order, content, to)
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > most)
    large, count, _ = stage_sized(groups.select(*by, F.lit(True).alias("__large")), "large-groups")
    if not count:
        return plain(df)
    flagged = null_safe_join(df, F.broadcast(large), by)
    small = plain(flagged.filter(F.col("__large").isNull()).drop("__large"))
    return small.unionByName(_numbered_by_range(flagged.filter("__large").drop("__large"), by, order, content, to))


def _numbered_by_range(df: DataFrame, by: Sequence[str], order: Sequence[Column], content: Column, to: str) -> DataFrame:
    """Row numbers of groups that no task could hold; exact copies are spread by the task they come from."""
    keys = [*[F.col(f"`{c}`") for c in by], *order, F.col("__content"), F.col("__task")]
    spread_out = df.withColumn("__content", content).withColumn("__task", F.spark_partition_id())
    ranged = spread_out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # partition number and index in the partition, in one number
    ranged = stage(ranged.withColumn("__row", F.monotonically_increasing_id()).drop("__content", "__task"), "ranged")
    ranged = ranged.withColumn("__part", F.shiftright("__row", 33))
    parts = ranged.groupBy("__part", *by).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    numbered = null_safe_join(ranged, F.broadcast(parts), ["__part", *by])
    number = F.col("__row") - F.col("__first") + 1 + F.col("__before")
    return numbered.withColumn(to, number.cast("long")).drop("__row", "__part", "__first", "__before")


def with_dense_rank(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    to: str,
    one_task_rows: int = ONE_TASK_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Rank the ``order`` values inside every ``by`` group; equal values share a rank."""
    if (df.count() if rows is None else rows) <= one_task_rows:
        return df.withColumn(to, F.dense_rank().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    values = df.select(*by, *order).distinct()
    ranked = with_row_number(values, by, order, to, one_task_rows)
    return sized_join(df, ranked, [*by, *order])


def with_chunk(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    size: int,
    to: str = "chunk",
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Cut every ``by`` group into numbered chunks of ``size`` rows, none of them empty."""
    numbered = with_row_number(df, by, order, "__number", one_task_rows)
    return numbered.withColumn(to, F.floor((F.col("__number") - 1) / size).cast("long")).drop("__number")
