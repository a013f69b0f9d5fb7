"""Long code -> label tables and the label sidecar of an export."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.skew import sized_join
from panelkit.operators.union import union_all


class LabelSource(NamedTuple):
    """A dictionary that labels a coded variable.

    Of the labels of a repeated code the last one in ``order`` (an integer column) counts,
    or the last in text order without one.
    """

    variable: str
    dim: DataFrame
    code: str
    label: str
    order: str | None = None


def label_table(sources: Iterable[LabelSource]) -> DataFrame:
    """(variable, code, label) over all dictionaries, codes as text; one shuffle for all."""

    def one(source: LabelSource) -> DataFrame:
        order = F.col(source.order) if source.order else F.lit(None)
        return source.dim.select(
            F.lit(source.variable).alias("variable"),
            F.col(source.code).cast("string").alias("code"),
            F.struct(
                order.cast("long").alias("order"), F.col(source.label).cast("string").alias("label")
            ).alias("last"),
        )

    every = union_all(map(one, sources))
    return every.groupBy("variable", "code").agg(F.max("last").alias("last")).select("variable", "code", "last.label")


def present_labels(labels: DataFrame, df: DataFrame) -> DataFrame:
    """The labels of columns the frame has."""
    return labels.filter(F.col("variable").isin([c.lower() for c in df.columns]))


def metric_labels(spark: SparkSession, df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """(variable, label) of every column: a metric's display label, else its own name."""
    rows = [(c.lower(), labels.get(c, c.lower())) for c in df.columns]
    return spark.createDataFrame(rows, "variable string, label string")


def labels_in_use(labels: DataFrame, used: DataFrame) -> DataFrame:
    """The labels whose (variable, code) occurs in the data."""
    return sized_join(labels, used, ["variable", "code"], "left_semi")
