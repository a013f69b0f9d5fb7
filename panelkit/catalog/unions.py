"""Distinct rows, precedence, backfill and shares over line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.catalog.base import CENTS_SQL, cents, query, table
from panelkit.functions.columns import round_metrics
from panelkit.operators import union as U
from panelkit.operators.shares import with_shares
from panelkit.session import stage


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(spark, sf_dir):
    return U.distinct_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT l_orderkey, l_linenumber, min(l_returnflag || l_linestatus) AS file FROM lineitem GROUP BY 1, 2"""
)
def distinct_no_file(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("file")
    )
    return U.distinct_without(lines, "file")


OLD = "l_shipdate < '1998-07-01'"
NEW = "l_shipdate >= '1998-01-01'"


@query(
    f"""WITH u AS (
      SELECT 0 AS p, l_orderkey, l_linenumber, l_quantity, l_extendedprice, NULL::DOUBLE AS l_tax
        FROM lineitem WHERE {OLD}
      UNION ALL SELECT 1, l_orderkey, l_linenumber, l_quantity * 10, l_extendedprice, l_tax FROM lineitem WHERE {NEW})
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax FROM u
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY p, l_quantity NULLS FIRST,
      l_extendedprice NULLS FIRST, l_tax NULLS FIRST) = 1"""
)
def precedence_union(spark, sf_dir):
    """Old rows win over new ones of the same key; old rows lack one metric."""
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    old = lines.filter(OLD).select(*keys, "l_quantity", "l_extendedprice")
    new = lines.filter(NEW).select(
        *keys, (F.col("l_quantity") * 10).alias("l_quantity"), "l_extendedprice", "l_tax"
    )
    return U.first_by_priority([old, new])


@query(
    f"""SELECT l_orderkey, l_linenumber, l_quantity, NULL::DOUBLE AS l_tax, CAST(l_linenumber AS BIGINT) AS line
      FROM lineitem WHERE {OLD}
    UNION ALL SELECT l_orderkey, NULL, l_quantity, l_tax, l_linenumber + l_orderkey FROM lineitem WHERE {NEW}"""
)
def union_fill(spark, sf_dir):
    """Frames with different columns, and an int beside a long."""
    lines = table(spark, sf_dir, "lineitem")
    old = lines.filter(OLD).select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_linenumber").alias("line"))
    line = (F.col("l_linenumber") + F.col("l_orderkey")).alias("line")
    new = lines.filter(NEW).select("l_orderkey", "l_quantity", "l_tax", line)
    return U.union_all([old, new], fill=True)


BACKFILL_SQL = f"""WITH old AS (
      SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, max(l_quantity) AS l_quantity
      FROM lineitem WHERE {OLD} GROUP BY 1, 2),
    new AS (SELECT DISTINCT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, l_returnflag, l_tax
      FROM lineitem WHERE {NEW})
    SELECT old.*, new.l_returnflag, new.l_tax FROM old LEFT JOIN new
      ON old.l_orderkey = new.l_orderkey AND old.l_linenumber IS NOT DISTINCT FROM new.l_linenumber"""


def _backfill(spark, sf_dir, **options):
    lines = table(spark, sf_dir, "lineitem").withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(7)))
    keys = ["l_orderkey", "l_linenumber"]
    old = lines.filter(OLD).groupBy(*keys).agg(F.max("l_quantity").alias("l_quantity"))
    old = old.withColumn("l_tax", F.lit(None).cast("double"))
    new = lines.filter(NEW).select(*keys, "l_returnflag", "l_quantity", "l_tax")
    return U.backfill(old, new, ["l_tax"], **options)


@query(BACKFILL_SQL)
def backfill(spark, sf_dir):
    return _backfill(spark, sf_dir)


@query(BACKFILL_SQL)
def large_backfill(spark, sf_dir):
    """The same backfill the way it runs on two large tables."""
    return _backfill(spark, sf_dir, limit=0)


def panel(spark, sf_dir):
    """Panel rows by product type, brand, year and buyer segment, with the demographic
    total of every product and year as group 1. Purchases stand in for buyers."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    rows = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
    )
    keys = ["p_type", "p_brand", "year"]
    segments = rows.groupBy(*keys, "c_mktsegment").agg(
        F.sum(cents("l_extendedprice")).alias("spend"),
        F.count("*").alias("buyers"),
    )
    segments = stage(segments, "segments")
    total = segments.groupBy(*keys).agg(F.sum("spend").alias("spend"), F.sum("buyers").alias("buyers"))
    both = U.union_all(
        [
            segments.select("*", F.lit(2).alias("demo_groups")),
            total.select("*", F.lit("TOTAL").alias("c_mktsegment"), F.lit(1).alias("demo_groups")),
        ]
    )
    return both.select(
        *keys,
        "c_mktsegment",
        "demo_groups",
        (F.col("spend") / 100).alias("spend_local_currency"),
        F.col("buyers").cast("double").alias("buying_households"),
    )


SHARE_SQL = f"""WITH rows AS (SELECT p_type, p_brand, CAST(year(o_orderdate) AS INTEGER) AS "year", c_mktsegment,
        {CENTS_SQL} AS price
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey),
    panel AS (
      SELECT p_type, p_brand, "year", c_mktsegment, 2 AS demo_groups, CAST(sum(price) AS DOUBLE) / 100 AS spend,
        CAST(count(*) AS DOUBLE) AS buyers FROM rows GROUP BY ALL
      UNION ALL SELECT p_type, p_brand, "year", 'TOTAL', 1, CAST(sum(price) AS DOUBLE) / 100,
        CAST(count(*) AS DOUBLE) FROM rows GROUP BY ALL)
    SELECT p.p_type, p.p_brand, p."year", p.c_mktsegment, p.demo_groups, p.spend AS spend_local_currency,
      p.buyers AS buying_households,
      round_even(p.spend / nullif(t.spend, 0) * 100 * 1000, 0) / 1000 AS value_share,
      round_even(p.buyers / nullif(t.buyers, 0) * 100 * 1000, 0) / 1000 AS buyers_share
    FROM panel p LEFT JOIN panel t ON t.demo_groups = 1 AND t.p_type = p.p_type AND t.p_brand = p.p_brand
      AND t."year" = p."year" """


def _shares(spark, sf_dir, **options):
    shared = with_shares(panel(spark, sf_dir), ["p_type", "p_brand", "year"], **options)
    return round_metrics(shared, ["value_share", "buyers_share"])


@query(SHARE_SQL)
def demographic_share(spark, sf_dir):
    return _shares(spark, sf_dir)


@query(SHARE_SQL)
def large_demographic_share(spark, sf_dir):
    """The same shares the way they run when the totals are too many to broadcast."""
    return _shares(spark, sf_dir, limit=0)


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity / t.q * 100 AS quantity_share
    FROM lineitem l LEFT JOIN (SELECT l_partkey, max(l_quantity) AS q FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY 1) t USING (l_partkey)"""
)
def line_share_of_largest_return(spark, sf_dir):
    """Shares over the whole fact table: each line against the largest returned line of its part."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity"
    )
    best = lines.filter("l_returnflag = 'R'").groupBy("l_partkey").agg(F.max("l_quantity").alias("l_quantity"))
    facts = U.union_all(
        [lines.withColumn("demo", F.lit(2)), best.withColumn("demo", F.lit(1))], fill=True
    )
    shared = with_shares(facts, ["l_partkey"], {"quantity_share": "l_quantity"}, demo="demo")
    return shared.filter("demo = 2").drop("demo", "l_quantity")
