"""Data-quality reports: nulls, duplicates, coverage of codes and columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from panelkit.functions.columns import metric_columns
from panelkit.operators.skew import sized_join
from panelkit.operators.union import union_all
from panelkit.session import stage


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values and how many, in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "nulls").filter("nulls > 0")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame and an observation that fills with row and null counts when it is written."""
    seen = Observation(name)
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    return df.observe(seen, F.count("*").alias("__rows"), *nulls), seen


class Findings:
    """What a run found out about its input, counted by the writes it makes anyway: no table is read for it.

    A finding is (step, finding, name, n). Numbers of rows are always told, others only if there is something to tell.
    """

    def __init__(self) -> None:
        self._rows: list[tuple[str, str, str | None, int]] = []

    def add(self, step: str, finding: str, n: int, name: str | None = None) -> None:
        if n or finding == "rows":
            self._rows.append((step, finding, name, n))

    def missing(self, step: str, df: DataFrame, wanted: Iterable[str]) -> None:
        """Each wanted column the frame lacks."""
        for column in missing_columns(df, wanted):
            self.add(step, "missing column", 1, column)

    def staged(
        self, df: DataFrame, step: str, copies: str | None = None, also: Mapping[str, Column] | None = None
    ) -> DataFrame:
        """``df`` written and read back, with its rows, missing values and, under their names, the rows ``also`` is true for.

        ``copies`` names a column, left out of the table, that counts the rows each row stands for. The counts are taken
        by the tasks that write, each of which counts once however often it is run.
        """
        columns = [c for c in df.columns if c != copies]
        also = also or {}
        counts = [F.count(F.lit(1)).alias("rows")]
        if copies:
            counts.append(F.coalesce(F.sum(copies), F.lit(0)).alias("copies"))
        counts += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(columns)]
        counts += [F.count_if(condition).alias(f"also_{i}") for i, condition in enumerate(also.values())]
        seen = Observation(step)
        table = stage(df.observe(seen, *counts).select(*[F.col(f"`{c}`") for c in columns]), step)
        found = seen.get
        self.add(step, "rows", found["rows"])
        if copies:
            self.add(step, "repeated rows", found["copies"] - found["rows"])
        for i, column in enumerate(columns):
            self.add(step, "missing values", found[f"null_{i}"], column)
        for i, finding in enumerate(also):
            self.add(step, finding, found[f"also_{i}"])
        return table

    def table(self, spark: SparkSession) -> DataFrame:
        """All findings so far, in the order of their steps."""
        return spark.createDataFrame(self._rows, "step string, finding string, name string, n long")


def duplicate_counts(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct rows and the rows that repeat another, ``ignore`` left out of the comparison."""
    content = [c for c in df.columns if c not in ignore]
    per_row = df.groupBy(*content).agg(F.count("*").alias("n"))
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_rows")
    ).withColumn("repeated_rows", F.col("total_rows") - F.col("distinct_rows"))


def shape(df: DataFrame, step: str) -> DataFrame:
    """Rows and columns at a named step."""
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(step).alias("step"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def missing_columns(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """Wanted columns the frame lacks."""
    return [c for c in wanted if c not in df.columns]


def columns_without_labels(df: DataFrame, labelled: Iterable[str], floats: bool = False) -> list[str]:
    """Columns with neither dictionary nor metric label; metrics count only with ``floats``."""
    known = set(labelled) | (set() if floats else set(metric_columns(df)))
    return [c for c in df.columns if c not in known]


#: Codes of one bitmap.
BITMAP = 1 << 15


def codes_in_use(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Distinct (variable, code) over the coded columns.

    Whole-number codes from 1 to ``BITMAP`` are marked in one bitmap per variable, made in each task and combined: one pass over
    the facts without repeating a row, whatever the number of variables. Only a variable with other codes, or with codes
    that are no whole numbers, has these made distinct in a pass over its own column.
    """
    named = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    if not named:
        return df.sparkSession.createDataFrame([], "variable string, code string")
    whole = [(c, v) for c, v in named.items() if isinstance(df.schema[c].dataType, IntegralType)]
    rest = [(c, v, F.lit(True)) for c, v in named.items() if (c, v) not in whole]
    found: list[tuple[str, str | None]] = []
    if whole:
        steps = []
        for i, (c, _) in enumerate(whole):
            code = F.col(f"`{c}`").cast("long")
            inside = code.between(1, BITMAP)
            steps.append(F.bitmap_construct_agg(F.bitmap_bit_position(F.when(inside, code))).alias(f"b{i}"))
            steps += [F.count_if(code.isNull()).alias(f"n{i}"), F.count_if(~inside).alias(f"o{i}")]
        seen = df.agg(*steps).first()
        for i, (c, v) in enumerate(whole):
            bits = int.from_bytes(bytes(seen[f"b{i}"] or b""), "little")
            found += [(v, str(place + 1)) for place, bit in enumerate(reversed(f"{bits:b}")) if bit == "1"]
            found += [(v, None)] if seen[f"n{i}"] else []
            if seen[f"o{i}"]:
                rest.append((c, v, ~F.col(f"`{c}`").between(1, BITMAP)))
    frames = [df.sparkSession.createDataFrame(found, "variable string, code string")]
    for c, v, outside in rest:
        code = F.col(f"`{c}`").cast("string").alias("code")
        frames.append(df.filter(outside).select(F.lit(v).alias("variable"), code).distinct())
    return union_all(frames)


def uncovered_codes(df: DataFrame, labels: DataFrame, variables: Iterable[str]) -> DataFrame:
    """Values of the labelled ``variables`` that have no label; a missing value counts as uncovered."""
    used = codes_in_use(df, [c for c in dict.fromkeys(variables) if c in df.columns])
    return sized_join(used, labels.select("variable", "code"), ["variable", "code"], "left_anti")


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The combinations present, in order."""
    return df.select(*columns).distinct().orderBy(*columns)
