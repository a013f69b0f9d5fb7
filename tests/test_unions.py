from __future__ import annotations

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelkit.operators import union as U
from panelkit.operators.lookup import RepeatedKeyError
from panelkit.operators.shares import with_shares


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_one_row_per_content_from_the_first_file(spark):
    df = spark.createDataFrame([(1, 2.0, "b"), (1, 2.0, "a"), (None, 2.0, "c"), (None, 2.0, "d")], "k int, m double, file string")
    once = U.distinct_without(df)
    assert rows(once) == Counter({(1, 2.0, "a"): 1, (None, 2.0, "c"): 1})
    assert rows(U.distinct_without(once)) == rows(once)


def test_old_rows_win_and_missing_columns_are_filled(spark):
    old = spark.createDataFrame([(1, 1.0), (None, 5.0)], "k int, spend double")
    new = spark.createDataFrame([(1, 2.0, 9.0), (2, 3.0, 9.0), (None, 6.0, 9.0)], "k int, spend double, extra double")
    found = U.first_by_priority([old, new])
    assert rows(found, "k", "spend", "extra") == Counter({(1, 1.0, None): 1, (2, 3.0, 9.0): 1, (None, 5.0, None): 1})
    assert rows(U.first_by_priority([found])) == rows(found)


def test_rows_are_kept_whole(spark):
    df = spark.createDataFrame([(1, 1.0, 9.0), (1, 2.0, 0.0), (1, None, 7.0)], "k int, a double, b double")
    found = U.first_by_priority([df], conflict="conflict")
    assert rows(found, "k", "conflict") == Counter({(1, True): 1})
    assert rows(found, "a", "b") == Counter({(1.0, 9.0): 1})  # whole, and not the row with a gap


def test_the_fuller_row_of_the_first_frame_wins(spark):
    schema = "k int, a double, b double, c double"
    first = [(1, None, None, 1.0), (1, None, 2.0, 1.0), (2, 1.0, 1.0, 1.0), (2, 1.0, 1.0, 1.0), (3, None, None, None), (3, None, 8.0, 1.0), (3, None, 8.0, 0.5), (None, 1.0, 1.0, 2.0)]
    second = [(1, 9.0, 9.0, 9.0), (4, 5.0, None, 1.0), (4, None, 5.0, 1.0), (None, 0.0, 0.0, 0.0)]
    found = U.first_by_priority([spark.createDataFrame(x, schema) for x in (first, second)], conflict="conflict")
    assert rows(found) == Counter(
        [(1, None, 2.0, 1.0, False), (2, 1.0, 1.0, 1.0, False), (3, None, 8.0, 0.5, True), (None, 1.0, 1.0, 2.0, False), (4, None, 5.0, 1.0, True)]
    )


def test_the_winner_is_found_by_hashing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, a double")
    plan = U.first_by_priority([df])._jdf.queryExecution().executedPlan().toString()
    found = plan[: plan.index("min(struct")]  # without the part that settles conflicts
    assert "HashAggregate" in found and "min_by" in found and found.count("SortAggregate") == 1


def test_texts_put_back_after_the_distinct(spark):
    data = [(1, "a", None, 2.0), (1, "a", None, 2.0), (1, None, "a", 2.0), (2, "a", "b", None), (2, "a", "b", None)]
    df = spark.createDataFrame(data, "id int, t string, u string, m double")
    for limit in (0, 1 << 20):
        found = U.distinct_late(df, [["t", "u"]], limit)
        assert found.columns == df.columns and rows(found) == Counter(set(data))


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_first_file_by_number(spark, limit):
    data = [(i % 5, f"f{i:03d}" if i % 5 else None) for i in range(200)] + [(3, None), (None, "z"), (None, None)]
    df = spark.createDataFrame(data, "k int, file string")
    assert rows(U.distinct_without(df, limit=limit)) == Counter({(0, None): 1, (1, "f001"): 1, (2, "f002"): 1, (3, "f003"): 1, (4, "f004"): 1, (None, "z"): 1})
    plan = U.distinct_without(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_backfill(spark, limit):
    schema = "k int, shop int, spend double, volume double"
    old = spark.createDataFrame([(1, 1, 5.0, None), (2, None, 6.0, None), (3, 1, 7.0, None)], schema)
    new = spark.createDataFrame([(1, 1, 0.0, 7.0), (2, None, 0.0, 8.0), (9, 1, 0.0, 9.0)], schema)
    found = U.backfill(old, new, ["volume"], limit=limit, slices=2)
    assert rows(found) == Counter({(1, 1, 5.0, 7.0): 1, (2, None, 6.0, 8.0): 1, (3, 1, 7.0, None): 1})


@pytest.mark.parametrize("slices", [1, 2, 2000])
def test_backfill_fans_out_over_a_hot_key(spark, slices):
    old = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "k int, spend double")
    new = spark.createDataFrame([(1, i, float(i)) for i in range(300)] + [(2, 0, 1.0)], "k int, channel int, volume double")
    old = old.withColumn("volume", F.lit(None).cast("double"))
    found = U.backfill(old, new, ["volume"], limit=0, slices=slices)
    assert rows(found.groupBy("k").count()) == Counter({(1, 300): 1, (2, 1): 1, (3, 1): 1})
    assert found.filter("k <> 3 and volume is null").isEmpty()


def test_backfill_needs_unique_old_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, volume double")
    with pytest.raises(RepeatedKeyError):
        U.backfill(df, df, ["volume"])


SHARE_SCHEMA = "key string, demo_groups int, spend_local_currency double, buying_households double"


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_shares(spark, limit):
    data = [
        ("K1", 1, 200.0, 50.0), ("K1", 2, 50.0, 10.0), ("K1", 3, None, 5.0), ("K2", 2, 40.0, 8.0),
        (None, 1, 80.0, 4.0), (None, 2, 20.0, 1.0), ("K3", 1, 0.0, 0.0),
    ]
    found = with_shares(spark.createDataFrame(data, SHARE_SCHEMA), ["key"], limit=limit)
    assert rows(found, "key", "demo_groups", "value_share", "buyers_share") == Counter(
        {
            ("K1", 1, 100.0, 100.0): 1,
            ("K1", 2, 25.0, 20.0): 1,
            ("K1", 3, None, 10.0): 1,
            ("K2", 2, None, None): 1,
            (None, 1, 100.0, 100.0): 1,
            (None, 2, 25.0, 25.0): 1,
            ("K3", 1, None, None): 1,
        }
    )


@pytest.mark.parametrize("second", [11.0, None])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_unequal_totals_fail_and_equal_ones_count_once(spark, second, limit):
    same = spark.createDataFrame([("K", 1, 10.0, 1.0)] * 2 + [("K", 2, 5.0, 1.0)], SHARE_SCHEMA)
    assert rows(with_shares(same, ["key"], limit=limit), "value_share") == Counter({(100.0,): 2, (50.0,): 1})
    unequal = spark.createDataFrame([("K", 1, 10.0, 1.0), ("K", 1, second, 1.0)], SHARE_SCHEMA)
    with pytest.raises(PySparkException, match="more than one total"):
        with_shares(unequal, ["key"], limit=limit).collect()


def test_union_widens_and_fills(spark):
    a = spark.createDataFrame([(1, "x")], "k int, only string")
    b = spark.createDataFrame([(1 << 40,)], "k long")
    found = U.union_all([a, b], fill=True)
    assert rows(found) == Counter({(1, "x"): 1, (1 << 40, None): 1})


def test_large_backfill_checks_old_keys_in_the_join(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, volume double")
    with pytest.raises(PySparkException, match="repeats"):
        U.backfill(df, df, ["volume"], limit=0).collect()


def test_large_backfill_shuffles_each_side_once(spark):
    old = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("shop"), F.lit(1.0).alias("spend"), F.lit(None).cast("double").alias("volume"))
    new = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("shop"), F.rand(1).alias("volume"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = U.backfill(old, new, ["volume"], limit=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan
