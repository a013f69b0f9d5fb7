from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelkit.functions import columns as C
from panelkit.functions import periods as P
from panelkit.sources.files import base_name, category_of, category_of_first_token


def values(df, column):
    return [r[column] for r in df.collect()]


def test_positive_and_deny_list_drop_nulls(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 3.0), (3, None), (None, 1.0)], "id int, m double")
    assert values(C.keep_positive(df, "m"), "id") == [2, None]
    assert values(C.drop_ids(df, "id", [1]), "id") == [2, 3]


def test_conditional_deny_list_leaves_other_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (2, "a")], "id int, cat string")
    kept = C.drop_ids(df, "id", [1], F.col("cat") == "a").collect()
    assert [tuple(r) for r in kept] == [(1, "b"), (None, "b"), (2, "a")]


def test_reparent(spark):
    df = spark.createDataFrame([(5, 1, "a"), (5, 1, "b"), (6, 1, "a"), (None, 1, "a")], "id long, parent long, cat string")
    assert values(C.reparent(df, "id", "parent", {5: 9}, F.col("cat") == "a"), "parent") == [9, 1, 1, 1]


@pytest.mark.parametrize(
    "value, expected", [(1.0005, 1.0), (2.6755, 2.676), (0.0015, 0.002), (0.0005, 0.0), (None, None)]
)
def test_rounding_is_half_even_on_the_scaled_value(spark, value, expected):
    df = spark.createDataFrame([(value,)], "m double")
    assert df.select(C.rounded(F.col("m")).alias("m")).first().m == expected


def test_headers_renames_and_projection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Percent 2+ Time Buyers` int, `Spend USD` int, Other int")
    snake = C.snake_headers(df, plus=True)
    assert snake.columns == ["percent_2__time_buyers", "spend_usd", "other"]
    assert C.rename(snake, {"spend_usd": "spend", "none": "x"}).columns == ["percent_2__time_buyers", "spend", "other"]
    assert C.keep_present(snake, ["other", "gone", "spend_usd", "other"]).columns == ["other", "spend_usd"]
    assert C.lower_headers(df).columns == ["percent 2+ time buyers", "spend usd", "other"]


def test_numbered_columns_are_dropped(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "level_0 int, level_0_code int, level_note int, demo_lvls int")
    assert C.drop_matching(df, "level_", "demo_").columns == ["level_note", "demo_lvls"]


def test_defaults_fill_absent_and_missing_segments(spark):
    absent = spark.createDataFrame([("a",), ("b",)], "cat string")
    assert values(C.default_by(absent, "segment", "cat", {"a": "A"}), "segment") == ["A", None]
    some = spark.createDataFrame([("a", None), ("a", "own")], "cat string, segment string")
    assert values(C.default_by(some, "segment", "cat", {"a": "A"}), "segment") == ["A", "own"]


def test_metrics_are_the_floating_columns(spark):
    df = spark.createDataFrame([(1, "x", float("nan"), 2.0)], "code long, label string, m double, n double")
    assert C.metric_columns(df) == ["m", "n"]
    assert C.key_columns(df) == ["code", "label"]
    assert tuple(C.nan_to_null(df).first()) == (1, "x", None, 2.0)
    assert tuple(C.blank(C.to_thousands(df, ["n"]), ["m"]).first()) == (1, "x", None, 0.002)


def test_share_of_zero_or_unknown_total_is_null(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (0.0, 0.0), (1.0, None)], "m double, t double")
    assert values(df.select(C.share(F.col("m"), F.col("t")).alias("s")), "s") == [25.0, None, None, None]


NEW = [
    (12, 2024, 3, "MAT: Mar 2024", "MAT: 2024 (03) Mar"),
    (24, 2024, 3, "2MATs: Mar 2024", "2MATs: 2024 (03) Mar"),
    (3, 2024, 12, "3MMT: Dec 2024", "3MMT: 2024 (12) Dec"),
    (1, 2023, 9, "Month: Sep 2023", "Month: 2023 (09) Sep"),
]


def test_new_period_labels(spark):
    df = spark.createDataFrame([tuple(map(float, row[:3])) for row in NEW], "duration double, year double, month double")
    found = P.with_new_period_labels(df).collect()
    assert [(r.duration, r.year, r.month, r.period_lbl, r.label_num) for r in found] == NEW


def test_unknown_duration_fails_or_is_null(spark):
    df = spark.createDataFrame([(6, 2024, 3)], "duration int, year int, month int")
    with pytest.raises(PySparkException, match="no period label"):
        P.with_new_period_labels(df).collect()
    lenient = P.with_new_period_labels(df, strict=False).first()
    assert lenient.period_lbl is None and lenient.label_num is None


def test_old_period_labels_meet_the_new_numbered_ones(spark):
    df = spark.createDataFrame([("Monthly", 20240331), ("2MAT/ 104 we", 20241231), ("Weekly", 20240101)], "t string, d long")
    labelled = P.with_old_period_label(P.with_date_parts(df, "d"), "t")
    assert values(labelled, "period_lbl") == ["Month: 2024 (03) Mar", "2MATs: 2024 (12) Dec", None]
    assert values(P.unknown_period_types(labelled, "t"), "t") == ["Weekly"]


def test_month_names(spark):
    df = spark.createDataFrame([("01",), ("12",), ("13",)], "m string")
    assert values(df.select(P.month_name(F.col("m")).alias("n")), "n") == ["Jan", "Dec", "13"]


def test_category_of_file_names(spark):
    names = ["shampoo_allshops.parquet", "diapers_br.parquet", "x/femcare_q1.parquet", "Hair Conditioners.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    found = values(df.select(category_of(base_name(F.col("n"))).alias("c")), "c")
    assert found == ["Shampoos", "MALE B&R", "Feminine Care", "Hair Conditioners"]


@pytest.mark.parametrize("rule", [category_of, category_of_first_token])
def test_unknown_file_name_fails(spark, rule):
    df = spark.createDataFrame([("foo.parquet",)], "n string")
    with pytest.raises(PySparkException, match="no category in file name"):
        df.select(rule(F.col("n"))).collect()


def test_first_token_rule_is_exact(spark):
    df = spark.createDataFrame([("br_allshops.parquet",)], "n string")
    assert df.select(category_of_first_token(F.col("n")).alias("c")).first().c == "MALE B&R"
    other = spark.createDataFrame([("old-br_allshops.parquet",)], "n string")
    with pytest.raises(PySparkException):
        other.select(category_of_first_token(F.col("n"))).collect()
