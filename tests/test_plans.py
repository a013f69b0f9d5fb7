"""The end-to-end plans on hand-made deliveries in the panel's own schemas."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelkit import fixed
from panelkit.operators.hierarchy import BrokenTreeError
from panelkit.operators.quality import Findings
from panelkit.operators.registry import register_periods
from panelkit.plans import export, merged, new_format, old_format
from panelkit.session import stage

GROUPS = """`category name` string, `product name` string, `vendor product id` long, full_label string, product_code long,
    category_code int, feature string, feature_code int, product_hier string, product_lvls int"""
DETERGENT = "Laundry Detergents"


@pytest.fixture(scope="module")
def dims(spark):
    groups = [
        (DETERGENT, "All", 250000, DETERGENT, 600, 6, "total", 1, "0. Laundry Detergents", 0),
        (DETERGENT, "Gel", 250455, "Gel", 602, 6, "form", 2, "2.0. Gel", 1),
        (DETERGENT, "Powder", 250456, "Powder", 601, 6, "form", 2, "1.0. Powder", 1),
        (DETERGENT, "Gel caps", 475027, "Gel caps", 603, 6, "form", 2, "2.1.0. Gel caps", 2),
        ("Shampoos", "All", 900, "Shampoos", 400, 4, "total", 1, "0. Shampoos", 0),
        ("Shampoos", "Baby", 901, "Baby", 401, 4, "form", 2, "1.0. Baby", 1),
    ]
    demo = [
        (1, "TOTAL DEMOGRAPHICS", 1, "0. TOTAL", 0, 1), (20, "Age", 2, "1.0. Age", 1, 2),
        (21, "Age 18-30", 4, "1.1.0. Age 18-30", 2, 2), (22, "Age 31+", 5, "1.2.0. Age 31+", 2, 2),
    ]
    segments = [("Total Detergents excluding Bar", 61), ("Shampoos", 41)]
    shops = [("RUSSIA NATIONAL", 1, 1, 1, "National"), ("OK Hyper", 2, 2, 3, "Hyper")]
    demo_schema = "`buyer group id` long, buyers_gr_label string, demo_code long, demo_hier string, demo_lvls int, socdem_gr long"
    return new_format.Dictionaries(
        spark.createDataFrame(groups, GROUPS),
        spark.createDataFrame(demo, demo_schema),
        spark.createDataFrame(segments, "segment string, segment_code int"),
        spark.createDataFrame(shops, "position_name_shop string, shop_code int, shop_lvls int, channel_code int, channel_type string"),
        spark.createDataFrame([("3MMT/ 12we", 1), ("MAT/ 52 we", 2), ("2MATs/ 104 we", 3), ("Month", 4)], "time_period_type string, time_period_code int"),
    )


REGISTRY = "period_lbl string, label_num string, date_added string, period_code int, period_batch int"


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame([("Month: Mar 2024", "Month: 2024 (03) Mar", "d", 1, 1)], REGISTRY)


OLD = """`Category Name` string, `Product Name` string, `Vendor Product ID` long, `Parent Product ID` long, Segment string,
    `Buyer Group ID` long, `Buyer Group Parent ID` long, `Buyer Group Name` string, `Time Period Type` string,
    `Time Period End Date` long, Occasions double, `Buying Households` double, `Spend Local Currency` double,
    `Volume SU` double, `Panel Sample Size` double"""


@pytest.fixture(scope="module")
def old_raw(spark):
    products = [
        (DETERGENT, "All", 250000, 250000), (DETERGENT, "Gel", 250455, 250000), (DETERGENT, "Powder", 250456, 250000),
        (DETERGENT, "Gel caps", 475027, 475025), (DETERGENT, "Other caps", 475025, 250455),
        ("Shampoos", "All", 900, 900), ("Shampoos", "Baby", 901, 900),
    ]
    buyers = [(1, 1, "TOTAL DEMOGRAPHICS"), (20, 1, "Age"), (21, 20, "Age 18-30"), (22, 20, "Age 31+")]
    data = []
    for cat, name, pid, parent in products:
        for bid, up, group in buyers:
            if cat == "Shampoos" and bid == 21:
                continue
            spend = float(pid % 1000 * 1000 + bid)
            segment = "Total Detergents excluding Bar" if cat == DETERGENT else "Shampoos"
            row = (cat, name, pid, parent, segment, bid, up, group, "Monthly", 20240331, 5.0, 2000.0, spend, 3.0, 1.0)
            data += [row, row]
    data.append((DETERGENT, "Never bought", 1, 1, "x", 1, 1, "TOTAL DEMOGRAPHICS", "Monthly", 20240331, 0.0, 0.0, 0.0, 0.0, 0.0))
    return spark.createDataFrame(data, OLD)


def test_old_format(old_raw, dims, registry):
    prepared = old_format.prepare(old_raw, dims.products, dims.demo)
    facts = prepared.facts.collect()
    # Four detergent nodes by three groups (depth 1 left out), two shampoo nodes by two.
    assert len(facts) == 4 * 3 + 2 * 2
    hier = {(r["Vendor Product ID"], r["product_lvls"], r["product_hier"]) for r in facts}
    assert hier == {
        (250000, 0, "0. Laundry Detergents"), (250456, 1, "1.0. Powder"), (250455, 1, "2.0. Gel"),
        (475027, 2, "2.1.0. Gel caps"), (900, 0, "0. Shampoos"), (901, 1, "1.0. Baby"),
    }
    # Shampoos lack the first age group, so the second takes its rank there.
    demo = {(r["category"], r["Buyer Group ID"]): r["demo_hier"] for r in facts}
    assert demo[("0. Laundry Detergents", 22)] == "1.2.0. Age 31+"
    assert demo[("0. Shampoos", 22)] == "1.1.0. Age 31+"
    tree = {r["Vendor Product ID"]: r for r in prepared.category_tree.collect()}
    assert tree[475027]["level_1"] == "2.0. Gel" and tree[475027]["level_3"] == "2.1.0. Gel caps"

    coded = old_format.recode(prepared.facts, dims.products, dims.demo, dims.segments, registry, dims.types)
    row = coded.filter("products = 603 and demo_groups = 4").first()
    assert (row.category, row.features, row.cat_segment, row.product_hier, row.socdem_gr) == (6, 2, 61, 603, 2)
    assert (row.time_period_type, row.period_lbl, row.year) == (4, 1, 2024)
    assert (row.buying_households, row.spend_local_currency, row.volume_su) == (2.0, 27.021, None)
    assert (row.shop_code, row.shop_lvls, row.channel_code) == (1, 1, 1)
    assert "panel_sample_size" not in coded.columns
    misses = {r.variable: r.misses for r in old_format.recode_misses(coded).collect()}
    assert set(misses.values()) == {0} and len(misses) == 8


def test_old_format_fails_on_products_without_parent_or_label(old_raw, dims):
    orphan = old_raw.withColumn(
        "Parent Product ID", F.when(F.col("Vendor Product ID") == 901, 12345).otherwise(F.col("Parent Product ID"))
    )
    with pytest.raises(BrokenTreeError):
        old_format.prepare(orphan, dims.products, dims.demo)
    with pytest.raises(PySparkException, match="not in dictionary"):
        old_format.prepare(old_raw, dims.products.filter("product_code <> 401"), dims.demo)


NEW = """category string, `Category Name` string, `Buyer Group Name` string, Segment string, position_name_shop string,
    duration int, year int, month int, `Buying HH` double, `Spend Local Currency` double, `Volume SU` double, file string"""
WANTED = [
    "category", "products", "product_hier", "product_lvls", "features", "cat_segment", "demo_groups", "demo_hier",
    "demo_lvls", "socdem_gr", "time_period_type", "year", "period_lbl", "buying_households", "spend_local_currency",
    "volume_su", "shop_code", "shop_lvls", "channel_code", "file",
]
RENAMES = {"buying_hh": "buying_households"}


@pytest.fixture(scope="module")
def new_raw(spark):
    segment = "Total Detergents excluding Bars"
    d = (DETERGENT, "Gel")
    data = [
        (*d, "Total Population", segment, "Ok Hyper", 1, 2024, 3, 4.0, 200.0004, 7.0, "in/deterg_1.parquet"),
        (*d, "AGE 18-30", segment, "Ok Hyper", 1, 2024, 3, 1.0, 50.0, 7.0, "in/deterg_1.parquet"),
        (*d, "AGE 18-30", segment, "Ok Hyper", 1, 2024, 3, 1.0, 50.0004, 7.0, "in/deterg_2.parquet"),
        (*d, "Age 31+", segment, "RUSSIA NATIONAL", 1, 2024, 3, 1.0, 60.0, 7.0, "in/deterg_1.parquet"),
        (*d, "Age 18-30", segment, "RUSSIA NATIONAL", 1, 2024, 3, 9.0, 61.0, 8.0, "in/deterg_1.parquet"),
        ("x", "Baby", "Total Population", None, "RUSSIA NATIONAL", 12, 2024, 4, 0.0, 10.0, 7.0, "in/shampoo.parquet"),
        ("x", "Unknown", "Age", None, "Nowhere", 12, 2024, 4, 2.0, 10.0, 7.0, "in/shampoo.parquet"),
    ]
    return spark.createDataFrame(data, NEW)


@pytest.fixture(scope="module")
def grown(new_raw, registry):
    return stage(register_periods(new_format.labelled(new_raw), registry, "today"), "registry")


@pytest.fixture(scope="module")
def new_facts(new_raw, dims, grown):
    return stage(new_format.process(new_raw, dims, grown, RENAMES, WANTED), "new")


def test_new_format(new_facts):
    columns = ["category", "products", "cat_segment", "demo_groups", "shop_code", "period_lbl", "value_share", "buyers_share", "file"]
    assert Counter(tuple(r) for r in new_facts.select(columns).collect()) == Counter(
        [
            (6, 602, 61, 1, 2, 1, 100.0, 100.0, "in/deterg_1.parquet"),
            (6, 602, 61, 4, 2, 1, 25.0, 25.0, "in/deterg_1.parquet"),
            (6, 602, 61, 5, 1, 1, None, None, "in/deterg_1.parquet"),
            (6, 602, 61, 4, 1, 1, None, None, "in/deterg_1.parquet"),
            (4, 401, 41, 1, 1, 2, 100.0, None, "in/shampoo.parquet"),
            (None, None, 41, 2, None, 2, None, None, "in/shampoo.parquet"),
        ]
    )


def test_new_format_by_short_name_and_unknown_file(new_raw, dims, grown):
    known = new_raw.filter("`Category Name` <> 'Unknown'")
    found = new_format.process(known, dims, grown, RENAMES, WANTED, adaptive=True)
    assert found.filter("products is null").isEmpty()
    with pytest.raises(PySparkException, match="no category in file name"):
        new_format.process(new_raw.withColumn("file", F.lit("in/foo.parquet")), dims, grown, RENAMES, WANTED)


def test_merge_prefers_old_and_fills_its_volume(old_raw, dims, grown, new_facts):
    prepared = old_format.prepare(old_raw, dims.products, dims.demo)
    old = stage(old_format.recode(prepared.facts, dims.products, dims.demo, dims.segments, grown, dims.types), "old")
    new = new_facts.drop("file", "value_share", "buyers_share")
    found = merged.merge(old, new)
    both = found.filter("products = 602 and demo_groups = 4 and shop_code = 1").collect()
    assert [(r.spend_local_currency, r.volume_su, r.occasions) for r in both] == [(455.021, 8.0, 0.005)]
    assert found.filter("products = 602 and shop_code = 2").count() == 2
    assert old.count() + 5 >= found.count() >= old.count()
    assert found.filter("demo_groups = 1 and spend_local_currency > 0 and value_share <> 100").isEmpty()


def test_export(spark, new_facts, dims, grown, tmp_path):
    years = spark.createDataFrame([(2024, 2024)], "year_code int, year int")
    sources = export.label_sources(dims.products, dims.demo, dims.segments, dims.shops, grown, dims.types, years)
    checks = export.check(new_facts, sources)
    assert checks.unlabelled_columns == ["file"]
    uncovered = Counter(tuple(r) for r in checks.uncovered.collect())
    assert uncovered == Counter({(c, None): 1 for c in ("category", "products", "product_hier", "product_lvls", "features", "shop_code", "shop_lvls", "channel_code")})
    assert {r.column_name for r in checks.nulls.collect()} >= {"value_share", "category"}
    assert checks.coverage.count() == 6

    path = str(tmp_path / "out")
    export.export(new_facts, sources, path, chunk_rows=2)
    assert spark.read.parquet(f"{path}/data").count() == 6
    labels = spark.read.parquet(f"{path}/value_labels")
    assert labels.filter("variable = 'shop_code' and code = '2'").first().label == "OK Hyper"
    assert labels.filter("variable = 'level_0'").isEmpty()
    variables = {r.variable: r.label for r in spark.read.parquet(f"{path}/variable_labels").collect()}
    assert variables["value_share"] == fixed.METRIC_LABELS["value_share"] and variables["products"] == "products"
    latest = str(tmp_path / "latest")
    export.export(new_facts, sources, latest, registry=grown)
    assert {r.period_lbl for r in spark.read.parquet(f"{latest}/data").select("period_lbl").collect()} == {2}


def test_large_runs_join_each_dictionary_once(spark, old_raw, dims, registry, monkeypatch):
    from panelkit.operators import skew

    passes = []
    found = skew.HotKeys._find
    monkeypatch.setattr(skew.HotKeys, "_find", lambda self: passes.append(self.key_sets) or found(self))
    prepared = old_format.prepare(old_raw, dims.products, dims.demo)
    facts = stage(prepared.facts, "facts")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        coded = old_format.recode(facts, dims.products, dims.demo, dims.segments, registry, dims.types, limit=0)
        plan = coded._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.conf.unset(name)
    # one pass for the hot keys of seven lookups, and no join before the last is planned again
    assert [len(k) for k in passes] == [7]
    assert plan.count("SortMergeJoin") == 7 and plan.count("panel_sample_size") <= 1
    small = old_format.recode(facts, dims.products, dims.demo, dims.segments, registry, dims.types)
    assert sorted(map(str, coded.collect())) == sorted(map(str, small.collect()))


def test_a_run_reports_what_it_found(spark, old_raw, new_raw, dims, grown):
    findings = Findings()
    orphan = old_raw.withColumn("Buyer Group Parent ID", F.when(F.col("Buyer Group ID") == 21, 99).otherwise(F.col("Buyer Group Parent ID")))
    orphan = orphan.withColumn("Time Period Type", F.when(F.col("Buyer Group ID") == 22, "Daily").otherwise(F.col("Time Period Type")))
    prepared = old_format.prepare(orphan, dims.products, dims.demo, strict=False, findings=findings)
    plain = old_format.prepare(orphan, dims.products, dims.demo, strict=False)
    assert prepared.facts.columns == plain.facts.columns
    assert Counter(map(tuple, prepared.facts.collect())) == Counter(map(tuple, plain.facts.collect()))
    found = {(r.step, r.finding, r.name): r.n for r in findings.table(spark).collect()}
    assert found["buyer groups", "nodes no root leads to", None] == 1
    assert found["prepared", "rows", None] == found["prepared", "repeated rows", None] == 16
    assert found["prepared", "facts outside the buyer group tree", None] == 4
    assert found["prepared", "facts without period label", None] == 6
    assert ("prepared", "missing column", "Raw Shoppers") in found and ("prepared", "missing column", "Volume SU") not in found
    assert not any(finding == "nodes with several parents" for _, finding, _ in found)

    findings = Findings()
    facts = new_format.process(new_raw, dims, grown, RENAMES, [*WANTED, "weight"], findings=findings)
    found = {(r.step, r.finding, r.name): r.n for r in findings.table(spark).collect()}
    assert found["clean", "rows", None] == facts.count() == 6
    assert found["clean", "missing values", "products"] == 1 and found["clean", "missing column", "weight"] == 1


def test_findings_of_empty_and_clashing_tables(spark):
    findings = Findings()
    df = spark.createDataFrame([], "`a.b` int, rows long, copies int")
    assert findings.staged(df, "empty").columns == df.columns
    assert findings.staged(df.withColumn("__n", F.lit(1)), "counted", "__n").columns == df.columns
    assert [tuple(r) for r in findings.table(spark).collect()] == [("empty", "rows", None, 0), ("counted", "rows", None, 0)]


def test_parents_in_dispute_are_reported(spark, old_raw, dims):
    moved = old_raw.filter("`Vendor Product ID` = 901").withColumn("Parent Product ID", F.lit(1).cast("long"))
    moved = moved.withColumn("Time Period End Date", F.lit(20240430).cast("long"))
    findings = Findings()
    old_format.prepare(old_raw.unionByName(moved), dims.products, dims.demo, findings=findings)
    found = {(r.step, r.finding): r.n for r in findings.table(spark).collect() if r.name is None}
    assert found["products", "nodes with several parents"] == 1 and ("products", "nodes no root leads to") not in found
