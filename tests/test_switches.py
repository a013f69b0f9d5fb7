"""Sizes, formats and lenient modes do not drop rows or change results."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators.registry import new_periods
from panelkit.session import row_bytes
from panelkit.sources.files import dictionary


def test_nested_values_count_like_flat_ones(spark):
    flat = spark.range(3).select("id", F.lit("x" * 1000).alias("label"))
    size = lambda df: df.agg(F.sum(row_bytes(df))).first()[0]
    for nested in (F.struct("id", "label"), F.array("label"), F.create_map("id", "label"), F.struct(F.array(F.struct("label"))), F.encode("label", "UTF-8")):
        assert size(flat) <= size(flat.select("id", nested.alias("n"))) + 3 * 16 <= size(flat) + 3 * 100


def test_parquet_below_a_folder_named_like_csv(spark, tmp_path):
    path = f"{tmp_path}/x.csv_old/table"
    spark.createDataFrame([(1, "a")], "Code int, Label string").write.parquet(path)
    assert [tuple(r) for r in dictionary(spark, path).collect()] == [(1, "a")]


def test_null_labels_are_not_registered(spark):
    columns = "duration int, year int, month int, period_lbl string, label_num string"
    labelled = spark.createDataFrame([(6, 2024, 1, None, None), (1, 2024, 1, "Month: Jan 2024", "Month: 2024 (01) Jan")], columns)
    registry = spark.createDataFrame([], "period_lbl string")
    assert [r.period_lbl for r in new_periods(labelled, registry).collect()] == ["Month: Jan 2024"]
