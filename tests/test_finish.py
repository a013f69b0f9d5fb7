from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelkit.operators import quality as Q
from panelkit.operators.labels import LabelSource, label_table, metric_labels, present_labels
from panelkit.operators.lookup import RepeatedKeyError
from panelkit.operators.registry import attach_periods, in_latest_batch, register_periods
from panelkit.functions.periods import with_new_period_labels
from panelkit.session import stage, stage_sized, staging_root
from panelkit.sources import files, sinks


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_null_duplicate_and_shape_reports(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, 3, "a")], "k int, m int, file string")
    assert rows(Q.null_counts(df)) == Counter({("m", 2): 1})
    assert rows(Q.duplicate_counts(df, ["file"])) == Counter({(3, 2, 1): 1})
    assert rows(Q.duplicate_counts(df.limit(0))) == Counter({(0, 0, 0): 1})
    assert rows(Q.shape(df, "s")) == Counter({("s", 3, 3): 1})


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "x", 1.0)], "code int, other string, m double")
    assert Q.missing_columns(df, ["code", "gone"]) == ["gone"]
    assert Q.columns_without_labels(df, ["code"]) == ["other"]
    assert Q.columns_without_labels(df, ["code"], floats=True) == ["other", "m"]


def test_missing_values_are_uncovered(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (None, 5)], "v int, w int")
    dim = spark.createDataFrame([(1, "one"), (5, "five")], "code int, label string")
    labels = label_table([LabelSource("v", dim.filter("code = 1"), "code", "label"), LabelSource("w", dim, "code", "label")])
    assert rows(Q.uncovered_codes(df, labels, ["v", "w", "absent"])) == Counter({("v", "2"): 1, ("v", None): 1})


def test_last_label_of_a_repeated_code(spark):
    dim = spark.createDataFrame([(1, "z", 1), (1, "a", 2)], "code int, label string, seq int")
    assert rows(label_table([LabelSource("v", dim, "code", "label")]), "label") == Counter({("z",): 1})
    assert rows(label_table([LabelSource("v", dim, "code", "label", "seq")]), "label") == Counter({("a",): 1})


def test_labels_of_present_columns(spark):
    df = spark.createDataFrame([(1, 1.0)], "v int, spend double")
    labels = spark.createDataFrame([("v", "1", "x"), ("w", "1", "y")], "variable string, code string, label string")
    assert rows(present_labels(labels, df), "variable") == Counter({("v",): 1})
    assert rows(metric_labels(spark, df, {"spend": "Value"})) == Counter({("v", "v"): 1, ("spend", "Value"): 1})


REGISTRY = "period_lbl string, label_num string, date_added string, period_code int, period_batch int"


def facts(spark, data):
    return with_new_period_labels(spark.createDataFrame(data, "duration int, year int, month int"))


def test_registered_codes_are_stable_and_new_ones_follow(spark):
    registry = spark.createDataFrame(
        [("Month: Mar 2023", "Month: 2023 (03) Mar", "d", 3, 1), ("MAT: Jan 2023", "MAT: 2023 (01) Jan", "d", 1, 1),
         ("MAT: Feb 2023", "MAT: 2023 (02) Feb", "d", 2, 1)],
        REGISTRY,
    )
    new = facts(spark, [(12, 2024, 1), (1, 2024, 1), (1, 2023, 12), (12, 2023, 1), (1, 2024, 1)])
    grown = stage(register_periods(new, registry, "today"), "registry")
    codes = {r.period_lbl: (r.period_code, r.period_batch, r.date_added) for r in grown.collect()}
    assert codes == {
        "Month: Mar 2023": (3, 1, "d"),
        "MAT: Jan 2023": (1, 1, "d"),
        "MAT: Feb 2023": (2, 1, "d"),
        "Month: Dec 2023": (4, 2, "today"),
        "Month: Jan 2024": (5, 2, "today"),
        "MAT: Jan 2024": (6, 2, "today"),
    }
    assert rows(register_periods(new, grown, "later")) == rows(grown)
    types = spark.createDataFrame([("MAT/ 52 we", 2), ("Month", 4)], "time_period_type string, time_period_code int")
    attached = attach_periods(new, grown, types)
    assert rows(attached, "time_period_type", "period_lbl") == Counter({(2, 6): 1, (4, 5): 2, (4, 4): 1, (2, 1): 1})
    assert rows(in_latest_batch(attached, grown), "period_lbl") == Counter({(6,): 1, (5,): 2, (4,): 1})


def test_registry_codes_must_be_unique(spark):
    registry = spark.createDataFrame([("a", "a", "d", 1, 1), ("b", "b", "d", 1, 1)], REGISTRY)
    with pytest.raises(RepeatedKeyError):
        register_periods(facts(spark, [(1, 2024, 1)]), registry, "today")


def write_file(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


def test_deliveries_by_pattern(spark, tmp_path):
    write_file(tmp_path / "q1" / "shampoo_allshops.parquet", k=[1], m=[float("nan")])
    write_file(tmp_path / "q1" / "shampoo_tot.parquet", k=[2], m=[2.0])
    write_file(tmp_path / "q2" / "deep" / "femcare_allshops.parquet", k=[3], m=[3.0])
    write_file(tmp_path / "q2" / "femcare.pq", k=[4], m=[4.0])
    found = files.deliveries(spark, [str(tmp_path / "q1"), str(tmp_path / "q2")])
    assert rows(found) == Counter(
        {(1, None, "q1/shampoo_allshops.parquet"): 1, (3, 3.0, "deep/femcare_allshops.parquet"): 1}
    )
    everything = files.deliveries(spark, str(tmp_path), "*.p*q*", skip=None)
    assert everything.count() == 4


def test_stacked_files_keep_their_stem(spark, tmp_path):
    write_file(tmp_path / "a.parquet", k=[1])
    write_file(tmp_path / "b.pq.zstd", k=[2], extra=["x"])
    found = files.stacked(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.pq.zstd")])
    assert rows(found, "k", "extra", "file") == Counter({(1, None, "a"): 1, (2, "x", "b"): 1})


def test_csv_and_dictionaries(spark, tmp_path):
    (tmp_path / "d.csv").write_text("Code,LABEL\n1,one\n,none\n")
    flat = files.flat_csv(spark, str(tmp_path / "d.csv"), "Code int, LABEL string")
    assert rows(flat) == Counter({(1, "one"): 1, (None, "none"): 1})
    dim = files.dictionary(spark, str(tmp_path / "d.csv"))
    assert dim.columns == ["code", "label"] and dim.count() == 2
    with pytest.raises(Exception):
        files.flat_csv(spark, str(tmp_path / "d.csv"), "Wrong int, LABEL string").collect()


def test_wanted_columns_and_renames(spark):
    example = spark.createDataFrame([(1, 2)], "Category int, File int")
    assert files.wanted_columns(example) == ["category", "file", "shop_code", "shop_lvls", "channel_code"]
    legends = spark.createDataFrame([("a", "b"), (None, "c")], "mask string, colum string")
    assert files.metric_renames(legends) == {"a": "b"}


def test_chunk_files_hold_at_most_n_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, i) for i in range(25)] + [(2, i) for i in range(3)], "category int, id int")
    sinks.write_chunks(df, str(tmp_path / "out"), rows=10)
    found = spark.read.parquet(str(tmp_path / "out")).groupBy("category", F.input_file_name().alias("f")).count()
    sizes = Counter()
    for r in found.collect():
        assert r["count"] <= 10
        sizes[r["category"]] += r["count"]
    assert sizes == {1: 25, 2: 3}


def test_publish_modes(spark, tmp_path):
    path = str(tmp_path / "table")
    frames = [spark.range(i, i + 1) for i in range(4)]
    sinks.publish([frames[0]], path, "append")
    sinks.publish(frames[1:3], path, "reload")
    assert rows(sinks.published(spark, path)) == Counter({(1,): 1, (2,): 1})
    sinks.publish(frames[3:], path, "append")
    assert sinks.published(spark, path).count() == 3
    with pytest.raises(ValueError, match="publish mode"):
        sinks.publish(frames, path, "x")


def test_only_finished_results_are_reused(spark, tmp_path):
    path = str(tmp_path / "stored")
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    assert sinks.reuse_or_build(spark, path, build).count() == 3
    assert sinks.reuse_or_build(spark, path, build).count() == 3
    assert len(built) == 1
    (tmp_path / "stored" / "_SUCCESS").unlink()
    sinks.reuse_or_build(spark, path, build)
    assert len(built) == 2


def test_empty_reports_are_not_written(spark, tmp_path):
    assert not sinks.write_report(spark.range(0), str(tmp_path / "r"))
    assert sinks.write_report(spark.range(2), str(tmp_path / "r"))


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    sinks.write_version(spark.range(1), path, 1)
    sinks.write_version(spark.range(2), path, 2)
    df, version = sinks.latest_version(spark, path)
    assert (df.count(), version, df.columns) == (2, 2, ["id"])


def test_staging(spark):
    df = spark.createDataFrame([("abc", [1, 2]), (None, None)], "s string, a array<int>")
    staged, n, size = stage_sized(df, "t")
    assert rows(staged.select("s")) == Counter({("abc",): 1, (None,): 1})
    assert n == 2 and size > 30
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert staging_root(spark) == shared.rstrip("/")


def test_observed_counts_come_from_the_write(spark, tmp_path):
    df, seen = Q.observed(spark.createDataFrame([(1, None), (2, 3)], "k int, m int"), "obs")
    sinks.write_parquet(df, str(tmp_path / "o"), level=12)
    assert seen.get == {"__rows": 2, "k": 0, "m": 1}


def test_a_reload_that_fails_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    old, new = (spark.range(n).withColumn("x", F.lit(n)) for n in (3, 2))
    sinks.publish([old], path)
    with pytest.raises(PySparkException):
        sinks.publish([new, new.withColumn("x", F.raise_error(F.lit("broken")).cast("int"))], path)
    assert sinks.published(spark, path).count() == 3
    sinks.publish([new], path)
    assert sinks.published(spark, path).count() == 2
    with pytest.raises(ValueError, match="nothing is published"):
        sinks.published(spark, f"{tmp_path}/none")


def test_batches_stand_side_by_side(spark, tmp_path):
    rows_of = lambda data: spark.createDataFrame(data, "period_batch int, category string, x int")
    path = f"{tmp_path}/data"
    for data in ([(1, "a", 1), (1, "b", 2)], [(2, "a", 3), (2, "c", 4)], [(2, "a", 5)]):
        sinks.write_batch(rows_of(data), path, ["period_batch", "category"], 10)
    found = spark.read.parquet(path).select("period_batch", "category", "x")
    assert rows(found) == Counter([(1, "a", 1), (1, "b", 2), (2, "a", 5), (2, "c", 4)])


def test_an_empty_report_can_be_read(spark, tmp_path):
    path = f"{tmp_path}/report"
    assert not sinks.write_report(spark.createDataFrame([], "a int"), path)
    assert spark.read.parquet(path).columns == ["a"] and spark.read.parquet(path).count() == 0


def test_codes_in_bitmaps_and_beyond(spark):
    data = [(1, 32768, "a", None), (1, 32769, None, None), (7, -4, "a", None), (None, 0, "b", None)]
    df = spark.createDataFrame(data, "k int, big long, name string, none short")
    want = {("k", "1"), ("k", "7"), ("k", None), ("big", "32768"), ("big", "32769"), ("big", "-4"), ("big", "0")}
    want |= {("name", "a"), ("name", "b"), ("name", None), ("none", None)}
    assert rows(Q.codes_in_use(df, df.columns)) == Counter(want)
    assert Q.codes_in_use(df.limit(0), df.columns).count() == 0 and Q.codes_in_use(df, []).count() == 0
    plan = Q.codes_in_use(df, ["k", "none"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def test_a_scope_leaves_only_its_results(spark, tmp_path):
    import os

    from panelkit.session import side_by_side, stage, staging_root, staging_scope, unstage

    folder = f"{staging_root(spark)}/panelkit"
    spark.range(1).write.mode("ignore").parquet(f"{folder}/before")
    before = set(os.listdir(folder))
    with staging_scope(spark) as keep:
        side_by_side(lambda: stage(spark.range(2), "a"), lambda: stage(spark.range(3), "b"))
        with staging_scope(spark) as keep_inner:
            inner = keep_inner(stage(spark.range(4), "inner"))
        gone = stage(inner, "gone")
        unstage(gone, spark.range(1))
        result = keep(stage(inner.selectExpr("id + 1 AS id"), "result"))
    assert {n.split("-")[0] for n in set(os.listdir(folder)) - before} == {"result"}
    assert result.count() == 4
