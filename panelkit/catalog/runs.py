"""The end-to-end runs over panel deliveries made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit import fixed
from panelkit.catalog import panel
from panelkit.catalog.base import CENTS_SQL, query
from panelkit.operators.quality import Findings
from panelkit.operators.registry import register_periods
from panelkit.plans import export, merged, new_format, old_format
from panelkit.session import side_by_side, stage, staging_path

RENAMES = {"buying_hh": "buying_households"}
DIMENSIONS = [
    "category", "products", "product_hier", "product_lvls", "features", "cat_segment", "demo_groups",
    "demo_hier", "demo_lvls", "socdem_gr", "time_period_type", "year", "period_lbl",
]
METRICS = ["buying_households", "spend_local_currency", "volume_su"]
WANTED = [*DIMENSIONS, *METRICS, "shop_code", "shop_lvls", "channel_code", "file"]

CELLS_SQL = f"""lines AS (SELECT CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
        WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS k, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS b,
        p_size // 10 AS s, c_mktsegment AS seg, o_orderstatus AS st, CAST(year(o_orderdate) AS INTEGER) AS y,
        CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS occ, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS buy,
        {CENTS_SQL} AS price, CAST(l_quantity AS BIGINT) AS vol
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey),
    names AS (SELECT * FROM (VALUES (1, 'Diapers', 'Diapers', 'diapers'), (2, 'MALE B&R', 'MALE B&R', 'MALE B&R'),
      (3, 'Hair Conditioners', 'Conditioners', 'haircond'), (4, 'Shampoos', 'Shampoos', 'shampoo'),
      (5, 'Feminine Care', 'Total Feminine Care', 'femcare'), (6, 'Laundry Detergents', 'Laundry Detergents', 'deterg'))
      AS n(k, cat, root, piece)),
    groups AS (SELECT * FROM (VALUES ('AUTOMOBILE', 10), ('BUILDING', 11), ('FURNITURE', 12), ('HOUSEHOLD', 13),
      ('MACHINERY', 14)) AS g(seg, bid))"""

OLD_SQL = f"""{CELLS_SQL},
    by_product AS (
      SELECT l.*, 0 AS depth, l.k * 1000000 AS pid, n.root AS plabel, 0 AS feature, l.k * 1000000 AS pparent
        FROM lines l JOIN names n USING (k)
      UNION ALL SELECT *, 1, k * 1000000 + b * 1000, 'Brand ' || b, 0, k * 1000000 FROM lines
      UNION ALL SELECT *, 2, k * 1000000 + b * 1000 + s + 1, 'Brand ' || b || ' class ' || s, s + 1,
        k * 1000000 + b * 1000 FROM lines),
    by_buyer AS (
      SELECT *, 1 AS bid, 0 AS demo_lvls, 'TOTAL DEMOGRAPHICS' AS blabel FROM by_product
      UNION ALL SELECT p.*, g.bid, 2, seg FROM by_product p JOIN groups g USING (seg)),
    facts AS (SELECT k, pid, pparent, depth, plabel, feature, bid, demo_lvls, blabel, y,
        CAST(sum(occ) AS DOUBLE) AS occ, CAST(sum(buy) AS DOUBLE) AS buy, CAST(sum(price) AS DOUBLE) / 100 AS spend,
        CAST(sum(vol) AS DOUBLE) AS vol
      FROM by_buyer GROUP BY ALL HAVING sum(occ) > 0),
    brands AS (SELECT pid, dense_rank() OVER (PARTITION BY k ORDER BY 10000000 - pid) AS r
      FROM (SELECT DISTINCT k, pid FROM facts WHERE depth = 1)),
    leaves AS (SELECT pid, pparent, dense_rank() OVER (PARTITION BY pparent ORDER BY 10000000 - pid) AS r
      FROM (SELECT DISTINCT pparent, pid FROM facts WHERE depth = 2)),
    buyers AS (SELECT k, bid, dense_rank() OVER (PARTITION BY k ORDER BY bid) AS r
      FROM (SELECT DISTINCT k, bid FROM facts WHERE demo_lvls = 2))"""


def _prepared(base, dims, **options):
    # Read several times by the plan, so written once, as a delivered file would be.
    raw = stage(panel.old_raw(base), "old-raw")
    return old_format.prepare(raw, dims.products, dims.demo, **options)


@query(
    f"""WITH {OLD_SQL}
    SELECT f.pid AS product, f.plabel AS product_name, 'feature ' || feature AS feature, 'All ' || cat AS segment,
      f.depth AS product_lvls,
      CASE f.depth WHEN 0 THEN '' WHEN 1 THEN br.r || '.' ELSE pr.r || '.' || lf.r || '.' END || '0. ' || f.plabel
        AS product_hier,
      CAST(f.bid AS BIGINT) AS buyer_group, blabel AS buyer_name, demo_lvls,
      CASE WHEN f.bid = 1 THEN '' ELSE '1.' || bu.r || '.' END || '0. ' || blabel AS demo_hier,
      '0. ' || root AS category, CAST(f.k * 1000000 AS BIGINT) AS category_code,
      CASE WHEN f.bid = 1 THEN '0. TOTAL DEMOGRAPHICS' ELSE '1.0. Market segment' END AS socdem_gr,
      CAST(CASE WHEN f.bid = 1 THEN 1 ELSE 2 END AS BIGINT) AS socdem_gr_code,
      'MAT/ 52 we' AS period_type, CAST(y AS VARCHAR) AS "year", 'MAT: ' || y || ' (12) Dec' AS period_lbl,
      occ AS occasions, buy AS buyers, spend, vol AS volume
    FROM facts f JOIN names USING (k) LEFT JOIN brands br ON f.pid = br.pid LEFT JOIN leaves lf ON f.pid = lf.pid
    LEFT JOIN brands pr ON f.pparent = pr.pid AND depth = 2 LEFT JOIN buyers bu ON f.k = bu.k AND f.bid = bu.bid"""
)
def old_format_prepared(spark, sf_dir):
    """Old-format facts with both trees flattened and labelled."""
    base = panel.cells(spark, sf_dir)
    facts = _prepared(base, panel.dictionaries(base)).facts
    return facts.withColumnsRenamed(
        {
            "Vendor Product ID": "product",
            "Product Name": "product_name",
            "Segment": "segment",
            "Buyer Group ID": "buyer_group",
            "Buyer Group Name": "buyer_name",
            "Time Period Type": "period_type",
            "Occasions": "occasions",
            "Buying Households": "buyers",
            "Spend Local Currency": "spend",
            "Volume SU": "volume",
        }
    )


# Registered periods keep their codes; the years from 1998 on follow the highest of them.
PERIODS_SQL = """periods AS (SELECT y, CAST(CASE WHEN y < 1998 THEN y - 1900
        ELSE (SELECT max(y) - 1900 FROM lines WHERE y < 1998) + row_number() OVER (PARTITION BY y < 1998 ORDER BY y)
        END AS INTEGER) AS period FROM (SELECT DISTINCT y FROM lines))"""

OLD_CODED_SQL = """old_coded AS (SELECT f.k AS category, CAST(10000000 - pid AS BIGINT) AS products,
        CAST(10000000 - pid AS BIGINT) AS product_hier, depth AS product_lvls, CAST(feature AS BIGINT) AS features,
        f.k AS cat_segment, CAST(bid AS BIGINT) AS demo_groups, CAST(bid AS BIGINT) AS demo_hier, demo_lvls,
        CAST(CASE WHEN bid = 1 THEN 1 ELSE 2 END AS BIGINT) AS socdem_gr, 2 AS time_period_type, y AS "year",
        period AS period_lbl, 1 AS shop_code, 1 AS shop_lvls, 1 AS channel_code,
        buy / 1000 AS buying_households, spend / 1000 AS spend_local_currency, occ / 1000 AS occasions,
        NULL::DOUBLE AS volume_su
      FROM facts f JOIN periods USING (y))"""


def _delivered(base):
    """New-format deliveries, written as files are delivered: registry and facts both read them."""
    return stage(panel.new_raw(base), "new-raw")


def _registered(base, raw):
    """The registry grown by the periods of the new deliveries."""
    labelled = new_format.labelled(raw)
    return stage(register_periods(labelled, panel.first_registry(base), "2024-06-01"), "registry")


def _recoded(base, dims, registry, **options):
    facts = _prepared(base, dims, **options).facts
    return old_format.recode(facts, dims.products, dims.demo, dims.segments, registry, dims.types, **options)


@query(f"WITH {OLD_SQL}, {PERIODS_SQL}, {OLD_CODED_SQL} SELECT * FROM old_coded")
def old_format_recoded(spark, sf_dir):
    """Old-format facts as codes, metrics in thousands."""
    base, dims, _, registry = _inputs(spark, sf_dir)
    return _recoded(base, dims, registry)


@query(f"WITH {OLD_SQL}, {PERIODS_SQL}, {OLD_CODED_SQL} SELECT * FROM old_coded")
def large_old_format_recoded(spark, sf_dir):
    """The same run the way it goes when no dictionary and no tree is small enough to broadcast."""
    base, dims, _, registry = _inputs(spark, sf_dir)
    return _recoded(base, dims, registry, limit=0)


@query(
    f"""WITH {OLD_SQL}, {PERIODS_SQL}, {OLD_CODED_SQL},
    missed AS (SELECT * REPLACE (nullif(cat_segment, 6) AS cat_segment) FROM old_coded)
    UNPIVOT (SELECT count(*) - count(products) AS products, count(*) - count(features) AS features,
      count(*) - count(cat_segment) AS cat_segment, count(*) - count(category) AS category,
      count(*) - count(socdem_gr) AS socdem_gr, count(*) - count(demo_groups) AS demo_groups,
      count(*) - count(time_period_type) AS time_period_type, count(*) - count(period_lbl) AS period_lbl FROM missed)
    ON COLUMNS(*) INTO NAME variable VALUE misses"""
)
def old_format_misses(spark, sf_dir):
    """Rows without a code when the segment dictionary lacks one category."""
    base, dims, _, registry = _inputs(spark, sf_dir)
    dims = dims._replace(segments=dims.segments.filter("segment_code <> 6"))
    return old_format.recode_misses(_recoded(base, dims, registry))


NEW_SQL = """new_rows AS (
      SELECT k, pid, depth, bid, shop, y, CAST(sum(buy) AS DOUBLE) AS buy, CAST(sum(price) AS DOUBLE) / 700 AS spend,
        CAST(sum(vol) AS DOUBLE) / 7 AS vol
      FROM (SELECT * FROM by_buyer WHERE depth < 2) CROSS JOIN (VALUES ('National'), ('Status')) AS s(scope),
        LATERAL (SELECT CASE WHEN scope = 'National' THEN 1 WHEN st = 'F' THEN 2 WHEN st = 'O' THEN 3 ELSE 4 END AS shop)
      GROUP BY ALL),
    new_coded AS (SELECT r.k AS category, CAST(10000000 - pid AS BIGINT) AS products,
        CAST(10000000 - pid AS BIGINT) AS product_hier, depth AS product_lvls, CAST(0 AS BIGINT) AS features,
        CASE r.k WHEN 4 THEN 14 WHEN 5 THEN 15 ELSE r.k END AS cat_segment,
        CAST(bid AS BIGINT) AS demo_groups, CAST(bid AS BIGINT) AS demo_hier,
        CASE WHEN bid = 1 THEN 0 ELSE 2 END AS demo_lvls, CAST(CASE WHEN bid = 1 THEN 1 ELSE 2 END AS BIGINT) AS socdem_gr,
        2 AS time_period_type, y AS "year", period AS period_lbl, shop AS shop_code,
        CASE WHEN shop = 1 THEN 1 ELSE 2 END AS shop_lvls, CASE WHEN shop = 1 THEN 1 ELSE 5 END AS channel_code,
        'first/' || piece || '_allshops.parquet' AS file,
        round_even(buy * 1000, 0) / 1000 AS buying_households, round_even(spend * 1000, 0) / 1000 AS spend_local_currency,
        round_even(vol * 1000, 0) / 1000 AS volume_su
      FROM new_rows r JOIN names USING (k) JOIN periods USING (y))"""


def shared_sql(rows: str, keys: str) -> str:
    return f"""SELECT c.*, c.spend_local_currency / nullif(t.spend, 0) * 100 AS value_share,
      c.buying_households / nullif(t.buyers, 0) * 100 AS buyers_share
    FROM {rows} c LEFT JOIN (SELECT {keys}, max(spend_local_currency) AS spend, max(buying_households) AS buyers
      FROM {rows} WHERE demo_groups = 1 GROUP BY {keys}) t USING ({keys})"""


NEW_KEYS = "products, shop_code, period_lbl, file"


def _inputs(spark, sf_dir):
    """Cells, dictionaries, new-format deliveries and the registry that knows their periods."""
    base = panel.cells(spark, sf_dir)
    dims, raw = side_by_side(lambda: panel.dictionaries(base), lambda: _delivered(base))
    return base, dims, raw, _registered(base, raw)


def _processed(raw, dims, registry, **options):
    return new_format.process(raw, dims, registry, RENAMES, WANTED, **options)


@query(f"WITH {OLD_SQL}, {PERIODS_SQL}, {NEW_SQL} {shared_sql('new_coded', NEW_KEYS)}")
def new_format_processed(spark, sf_dir):
    """New-format deliveries coded, cleaned of repeated files and given shares."""
    _, dims, raw, registry = _inputs(spark, sf_dir)
    return _processed(raw, dims, registry)


@query(f"WITH {OLD_SQL}, {PERIODS_SQL}, {NEW_SQL} {shared_sql('new_coded', NEW_KEYS)}")
def large_new_format_processed(spark, sf_dir):
    """The same run the way it goes when no dictionary is small enough to broadcast."""
    _, dims, raw, registry = _inputs(spark, sf_dir)
    return _processed(raw, dims, registry, limit=0)


@query(
    f"""WITH {OLD_SQL}, {PERIODS_SQL}, {NEW_SQL}
    SELECT 'clean' AS step, 'missing column' AS finding, 'panel_weight' AS name, CAST(1 AS BIGINT) AS n
    UNION ALL SELECT 'clean', 'rows', NULL, count(*) FROM new_coded
    UNION ALL SELECT 'clean', 'repeated rows', NULL, count(*) FROM new_coded WHERE "year" = 1998 HAVING count(*) > 0
    UNION ALL SELECT 'clean', 'missing values', 'cat_segment', count(*) FROM new_coded WHERE category = 6
      HAVING count(*) > 0"""
)
def new_format_findings(spark, sf_dir):
    """What a run over new-format deliveries reports: here a segment without code and a column no delivery has."""
    _, dims, raw, registry = _inputs(spark, sf_dir)
    findings = Findings()
    known = dims._replace(segments=dims.segments.filter("segment_code <> 6"))
    new_format.process(raw, known, registry, RENAMES, [*WANTED, "panel_weight"], findings=findings)
    return findings.table(spark)


DELIVERED_METRICS = ["Occasions", "Buying Households", "Spend Local Currency", "Volume SU"]
ABSENT_SQL = ", ".join(f"('{m}')" for m in fixed.OLD_METRICS if m not in DELIVERED_METRICS)


@query(
    f"""WITH {OLD_SQL},
    outside AS (SELECT count(*) AS n FROM facts WHERE bid = 14)
    SELECT 'prepared' AS step, 'missing column' AS finding, name, CAST(1 AS BIGINT) AS n
      FROM (VALUES {ABSENT_SQL}) AS absent(name)
    UNION ALL SELECT 'products', 'rows', NULL, count(DISTINCT pid) FROM facts
    UNION ALL SELECT * FROM (SELECT 'products', 'nodes with several parents', NULL, count(*) AS n FROM (SELECT pid
      FROM facts WHERE depth = 2 GROUP BY pid HAVING bool_or(y = 1995) AND bool_or(y <> 1995))) WHERE n > 0
    UNION ALL SELECT 'buyer groups', 'rows', NULL, count(DISTINCT (k, bid)) + count(DISTINCT k) FROM facts
    UNION ALL SELECT * FROM (SELECT 'buyer groups', 'nodes no root leads to', NULL, count(DISTINCT k) AS n
      FROM facts WHERE bid = 14) WHERE n > 0
    UNION ALL SELECT 'prepared', 'rows', NULL, count(*) FROM facts
    UNION ALL SELECT 'prepared', 'repeated rows', NULL, count(*) FROM facts WHERE y = 1996 HAVING count(*) > 0
    UNION ALL SELECT 'prepared', 'missing values', name, n
      FROM outside, (VALUES ('demo_lvls'), ('demo_hier'), ('socdem_gr'), ('socdem_gr_code')) AS c(name) WHERE n > 0
    UNION ALL SELECT 'prepared', 'facts outside the buyer group tree', NULL, n FROM outside WHERE n > 0"""
)
def old_format_findings(spark, sf_dir):
    """What a lenient run over old-format files reports: here a buyer group below an unknown one, leaves that stood
    elsewhere in 1995, and the rows of 1996 delivered twice."""
    base = panel.cells(spark, sf_dir)
    dims, raw = panel.dictionaries(base), panel.old_raw(base)
    product, end = F.col("Vendor Product ID"), F.col("Time Period End Date")
    elsewhere = (product % 1000 > 0) & (end == 19951231)
    raw = raw.withColumns(
        {
            "Parent Product ID": F.when(elsewhere, product - product % 1_000_000).otherwise(F.col("Parent Product ID")),
            "Buyer Group Parent ID": F.when(F.col("Buyer Group ID") == 14, 99).otherwise(F.col("Buyer Group Parent ID")),
        }
    )
    raw = stage(raw.unionByName(raw.filter(end == 19961231)), "old-raw")
    findings = Findings()
    old_format.prepare(raw, dims.products, dims.demo, strict=False, findings=findings)
    return findings.table(spark)


MERGED_SQL = f"""WITH {OLD_SQL}, {PERIODS_SQL}, {OLD_CODED_SQL}, {NEW_SQL},
    new_plain AS (SELECT * EXCLUDE (file), NULL::DOUBLE AS occasions FROM new_coded),
    filled AS (SELECT o.* EXCLUDE (volume_su), n.volume_su FROM old_coded o LEFT JOIN new_plain n
      ON o.products = n.products AND o.demo_groups = n.demo_groups AND o.period_lbl = n.period_lbl AND n.shop_code = 1
        AND o.cat_segment = n.cat_segment),
    every AS (SELECT 0 AS p, * FROM filled UNION ALL BY NAME SELECT 1 AS p, * FROM new_plain),
    united AS (SELECT * EXCLUDE (p) FROM every QUALIFY row_number() OVER (
      PARTITION BY products, cat_segment, demo_groups, period_lbl, shop_code ORDER BY p) = 1)"""


@query(f"{MERGED_SQL} {shared_sql('united', 'products, cat_segment, shop_code, period_lbl')}")
def merged_old_and_new(spark, sf_dir):
    """Old facts with volumes taken from the new ones, then the new facts the old lack."""
    base, dims, raw, registry = _inputs(spark, sf_dir)
    old, new = side_by_side(
        lambda: stage(_recoded(base, dims, registry), "old"),
        lambda: stage(_processed(raw, dims, registry).drop("file", "value_share", "buyers_share"), "new"),
    )
    return merged.merge(old, new)


def _sources(base, dims, registry):
    years = base.select(F.col("y").alias("year_code"), F.col("y").alias("year")).distinct()
    return export.label_sources(
        dims.products, dims.demo, dims.segments, dims.shops, registry, dims.types, years
    )


@query(
    f"""WITH {OLD_SQL}, {PERIODS_SQL}, {NEW_SQL} SELECT category, count(*) AS n_rows, true AS within_limit
    FROM new_coded WHERE "year" >= 1998 GROUP BY 1"""
)
def exported_latest_batch(spark, sf_dir):
    """The latest period batch exported in chunks of 500 rows with its label sidecar."""
    base, dims, raw, registry = _inputs(spark, sf_dir)
    path = staging_path(spark, "export")
    df = stage(_processed(raw, dims, registry), "processed")
    export.export(df, _sources(base, dims, registry), path, 500, registry)
    written = spark.read.parquet(f"{path}/data")
    per_file = written.groupBy("category", F.col("_metadata.file_path").alias("f")).count()
    return per_file.groupBy("category").agg(
        F.sum("count").alias("n_rows"), (F.max("count") <= 500).alias("within_limit")
    )


@query(
    f"""WITH {OLD_SQL}, {PERIODS_SQL}, {NEW_SQL} SELECT DISTINCT category, period_lbl, demo_groups, shop_code
    FROM new_coded"""
)
def export_coverage(spark, sf_dir):
    """The coverage table of an export whose codes all have labels."""
    base, dims, raw, registry = _inputs(spark, sf_dir)
    df = stage(_processed(raw, dims, registry), "processed")
    checks = export.check(df, _sources(base, dims, registry))
    if checks.unlabelled_columns != ["file"] or not checks.uncovered.isEmpty():
        raise ValueError("an export column or code has no label")
    return checks.coverage
