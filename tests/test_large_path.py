"""Chains of lookups that are too large to broadcast, with merge joins forced."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from panelkit.operators import lookup as L
from panelkit.operators import skew as K


@pytest.fixture
def merge_joins(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_the_plan_of_a_chain_grows_by_one_join_at_a_time(spark, tmp_path, merge_joins):
    rows = spark.range(900).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id") % 50).alias("key"), "id")
    rows.write.parquet(f"{tmp_path}/facts")
    spark.range(40).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("value")).write.parquet(f"{tmp_path}/dim")
    facts, dim = spark.read.parquet(f"{tmp_path}/facts"), spark.read.parquet(f"{tmp_path}/dim")
    hot = K.HotKeys(facts, ["key"], slices=20)
    assert hot.pieces(["key"])
    found, exchanges = facts, []
    for k in range(1, 7):
        found = L.lookup(found, dim.withColumnRenamed("value", f"v{k}"), ["key"], limit=0, hot=hot if k % 2 else None)
        start = time.perf_counter()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert time.perf_counter() - start < 5
        # paths are cut short in a plan's text, the read columns are not
        assert plan.count("ReadSchema: struct<key:bigint,id:bigint>") == 1 and "SortMergeJoin" in plan
        exchanges.append(plan.count("Exchange hashpartitioning"))
    assert all(after - before <= 3 for before, after in zip(exchanges, exchanges[1:], strict=False))
    seen = found.groupBy().agg(F.count("*"), *[F.sum(F.when(F.col(f"v{k}").eqNullSafe(F.when(F.col("key") < 40, F.concat(F.lit("v"), "key"))), 1)) for k in range(1, 7)])
    assert set(seen.first()) == {900}
