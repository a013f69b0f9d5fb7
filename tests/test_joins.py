from __future__ import annotations

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelkit.operators import lookup as L
from panelkit.operators import skew as K


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def facts(spark):
    """One key holds more than a third of the rows, all of them exact copies; some keys are null."""
    data = [(7, 1)] * 400 + [(i % 50, i) for i in range(600)] + [(None, 5)] * 30
    return spark.createDataFrame(data, "key int, m int").repartition(4)


@pytest.fixture(scope="module")
def dim(spark):
    data = [(i, f"v{i}") for i in range(40)] + [(None, "none")]
    return spark.createDataFrame(data, "key int, value string")


def expected(facts, dim):
    known = {r.key: r.value for r in dim.collect()}
    return Counter({(k, m, known.get(k)): n for (k, m), n in rows(facts).items()})


@pytest.mark.parametrize("limit", [0, K.BROADCAST_BYTES])
def test_lookup_keeps_every_row_and_null_meets_null(facts, dim, limit):
    assert rows(L.lookup(facts, dim, ["key"], limit=limit)) == expected(facts, dim)


def test_hot_key_is_cut_into_pieces(facts, dim):
    hot = K.hot_keys(facts, ["key"], slices=10)
    assert len(hot) == 1 and next(iter(hot.values())) > 3
    cut = K._cut(facts, hot, ["key"]).filter("key = 7").groupBy("__piece").count().collect()
    assert len(cut) > 1 and max(r["count"] for r in cut) < 300
    assert rows(K.join_hot_left(facts, dim, ["key"], slices=10)) == expected(facts, dim)


@pytest.mark.parametrize("slices", [1, 10, 2000])
def test_join_hot_right_matches_a_plain_left_join(spark, facts, slices):
    left = spark.createDataFrame([(7, "a"), (8, "b"), (None, "c"), (999, "d")], "key int, l string")
    plain = left.join(facts.withColumnRenamed("key", "k"), F.expr("key <=> k"), "left").drop("k")
    assert rows(K.join_hot_right(left, facts, ["key"], slices)) == rows(plain)


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "inner"])
@pytest.mark.parametrize("limit", [0, K.BROADCAST_BYTES])
def test_sized_join_flavours(facts, dim, how, limit):
    side = dim.select("key")
    found = K.sized_join(facts, side, ["key"], how, limit)
    known = {r.key for r in side.collect()}
    wanted = {row: n for row, n in rows(facts).items() if (row[0] in known) == (how != "left_anti")}
    assert rows(found) == Counter(wanted)


def test_broadcast_only_below_the_measured_limit(facts, dim):
    small = L.lookup(facts, dim, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small


def test_null_safe_join_is_no_nested_loop(facts, dim):
    plan = K.null_safe_join(facts, dim, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_repeated_dictionary_key_fails(spark, facts):
    twice = spark.createDataFrame([(None, "a"), (None, "b")], "key int, value string")
    with pytest.raises(L.RepeatedKeyError):
        L.lookup(facts, twice, ["key"])


def test_columns_on_both_sides_fail(facts, dim):
    with pytest.raises(ValueError, match="both sides"):
        L.lookup(facts, dim.withColumn("m", F.lit(1)), ["key"])


def test_strict_map_fails_on_unknown_and_passes_null(spark, dim):
    good = spark.createDataFrame([(1,), (None,)], "key int")
    mapped = L.strict_map(good, "key", dim.filter("key is not null"), "key", "value", "v")
    assert rows(mapped) == Counter({(1, "v1"): 1, (None, None): 1})
    bad = spark.createDataFrame([(77,)], "key int")
    with pytest.raises(PySparkException, match="not in dictionary"):
        L.strict_map(bad, "key", dim, "key", "value", "v").collect()


def test_soft_map_misses_are_counted(spark, dim):
    df = spark.createDataFrame([(1,), (77,), (78,)], "key int")
    mapped = L.soft_map(df, "key", dim, "key", "value", "v")
    assert rows(L.miss_counts(mapped, ["key", "v"])) == Counter({("key", 0): 1, ("v", 2): 1})


def test_inverse_map_takes_the_last_code(spark):
    dim = spark.createDataFrame([(1, "A", 9), (2, "A", 1), (3, "B", 0)], "code int, label string, seq int")
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "label string")
    assert rows(L.inverse_map(df, "label", dim, "code", "label", "c")) == Counter(
        {("A", 2): 1, ("B", 3): 1, ("C", None): 1}
    )
    by_seq = L.inverse_map(df, "label", dim, "code", "label", "c", order="seq")
    assert rows(by_seq)[("A", 1)] == 1


def test_adaptive_lookup_chooses_the_key_and_may_fan_out(spark):
    dim = spark.createDataFrame(
        [("c", "x", "full x", 1), ("c", "x", "full x2", 2), ("c", "y", "full y", 3)],
        "cat string, short string, full string, code int",
    )
    short = spark.createDataFrame([("c", "x"), ("c", "y")], "cat string, name string")
    found = L.adaptive_lookup(short, dim, "name", ["short", "full"], ["cat"])
    assert sorted(r.code for r in found.collect()) == [1, 2, 3]
    full = spark.createDataFrame([("c", "full x"), ("c", "y")], "cat string, name string")
    found = L.adaptive_lookup(full, dim, "name", ["short", "full"], ["cat"])
    assert {(r.name, r.code) for r in found.collect()} == {("full x", 1), ("y", None)}
    with pytest.raises(L.RepeatedKeyError):
        L.adaptive_lookup(short, dim, "name", ["short", "full"], ["cat"], validate=True)
