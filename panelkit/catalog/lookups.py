"""Dictionary lookups over customers, parts and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.catalog.base import query, table
from panelkit.operators import lookup as L
from panelkit.operators.skew import HotKeys


@query("SELECT c_custkey, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey")
def strict_map(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    return L.strict_map(customer, "c_nationkey", nation, "n_nationkey", "n_name", "nation").drop("c_nationkey")


def _soft(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    some = table(spark, sf_dir, "nation").filter("n_regionkey <> 0")
    df = L.soft_map(customer, "c_nationkey", some, "n_nationkey", "n_name", "nation")
    return L.soft_map(df, "c_nationkey", some, "n_nationkey", "n_regionkey", "region")


@query(
    """SELECT c_custkey, n_name AS nation, n_regionkey AS region FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 0"""
)
def soft_map(spark, sf_dir):
    return _soft(spark, sf_dir).select("c_custkey", "nation", "region")


@query(
    """WITH m AS (SELECT n_name, n_regionkey FROM customer
      LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 0)
    SELECT 'nation' AS variable, count(*) - count(n_name) AS misses FROM m
    UNION ALL SELECT 'region', count(*) - count(n_regionkey) FROM m"""
)
def soft_map_misses(spark, sf_dir):
    return L.miss_counts(_soft(spark, sf_dir), ["nation", "region"])


@query(
    """SELECT o_orderkey, code AS customer FROM orders JOIN customer c ON o_custkey = c_custkey
    JOIN (SELECT c_mktsegment, max(c_custkey) AS code FROM customer GROUP BY 1) i USING (c_mktsegment)"""
)
def inverse_map(spark, sf_dir):
    """A label that many codes share stands for its last code."""
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    labelled = L.soft_map(orders, "c_custkey", customer, "c_custkey", "c_mktsegment", "segment")
    coded = L.inverse_map(labelled, "segment", customer, "c_custkey", "c_mktsegment", "customer")
    return coded.select("o_orderkey", "customer")


@query(
    """SELECT o_orderkey, c_name, c_nationkey FROM orders
    LEFT JOIN customer ON nullif(o_custkey, 5) IS NOT DISTINCT FROM nullif(c_custkey, 7)"""
)
def validated_lookup(spark, sf_dir):
    """One row per key, and a null key meets the null key."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_custkey", F.lit(5)).alias("key")
    )
    customer = table(spark, sf_dir, "customer").select(
        F.nullif("c_custkey", F.lit(7)).alias("key"), "c_name", "c_nationkey"
    )
    return L.lookup(orders, customer, ["key"]).drop("key")


COMPOSITE_SQL = """WITH d AS (SELECT p_type, p_brand, min(p_partkey) AS product_code FROM part
      WHERE p_size > 10 GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, l_partkey, product_code FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN d USING (p_type, p_brand)"""


def _composite(spark, sf_dir, **options):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf_dir, "part")
    labels = part.select("p_partkey", "p_type", "p_brand")
    codes = part.filter("p_size > 10").groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("product_code"))
    labelled = L.lookup(lines, labels, {"l_partkey": "p_partkey"}, **options)
    return L.lookup(labelled, codes, ["p_type", "p_brand"], validate=False, **options).drop("p_type", "p_brand")  # grouped by its keys


@query(COMPOSITE_SQL)
def composite_lookup(spark, sf_dir):
    return _composite(spark, sf_dir)


@query(COMPOSITE_SQL)
def large_dictionary_lookup(spark, sf_dir):
    """The same lookup the way it runs when a dictionary is too large to broadcast."""
    return _composite(spark, sf_dir, limit=0)


@query(
    """SELECT l_orderkey, l_linenumber, p_type, s_name, ps_count, o_orderdate FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN (SELECT l_partkey, l_suppkey, count(*) AS ps_count FROM lineitem GROUP BY ALL) USING (l_partkey, l_suppkey)"""
)
def large_lookup_chain(spark, sf_dir):
    """Four lookups without broadcast; the hot keys of all are found on the facts before the first."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    pairs = lines.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("ps_count"))
    steps = [(part, ["l_partkey"]), (supplier, ["l_suppkey"]), (orders, ["l_orderkey"]), (pairs, ["l_partkey", "l_suppkey"])]
    hot = HotKeys(lines, *[keys for _, keys in steps])
    found = lines
    for dim, keys in steps:
        # grouped by its keys, pairs cannot repeat one; to check it would put two more hash tables of all its keys into each task
        found = L.lookup(found, dim, keys, validate=dim is not pairs, limit=0, hot=hot)
    return found.drop("l_partkey", "l_suppkey")


@query(
    """SELECT p.p_partkey, d.code FROM part p
    LEFT JOIN (SELECT p_type, p_brand || '/' || p_name AS full_label, min(p_partkey) AS code FROM part GROUP BY 1, 2) d
      ON p.p_type = d.p_type AND p.p_brand || '/' || p.p_name = d.full_label"""
)
def adaptive_lookup(spark, sf_dir):
    """Full labels, which the short names of the dictionary do not cover."""
    part = table(spark, sf_dir, "part")
    full = F.concat_ws("/", "p_brand", "p_name")
    facts = part.select("p_partkey", "p_type", full.alias("label"))
    dim = part.groupBy("p_type", full.alias("full_label")).agg(
        F.min("p_partkey").alias("code"), F.min("p_name").alias("short_label")
    )
    found = L.adaptive_lookup(facts, dim, "label", ["short_label", "full_label"], ["p_type"], validate=True)
    return found.select("p_partkey", "code")


@query(
    """SELECT p.p_partkey, d.code FROM part p
    LEFT JOIN (SELECT p_type, p_name, min(p_partkey) AS code FROM part GROUP BY 1, 2) d USING (p_type, p_name)"""
)
def adaptive_lookup_first_key(spark, sf_dir):
    """Short names, all of which the dictionary knows, so that the full labels are not tried."""
    part = table(spark, sf_dir, "part")
    facts = part.select("p_partkey", "p_type", F.col("p_name").alias("label"))
    dim = part.groupBy("p_type", F.col("p_name").alias("short_label")).agg(
        F.min("p_partkey").alias("code"), F.min(F.concat_ws("/", "p_brand", "p_name")).alias("full_label")
    )
    found = L.adaptive_lookup(facts, dim, "label", ["short_label", "full_label"], ["p_type"], validate=True)
    return found.select("p_partkey", "code")
