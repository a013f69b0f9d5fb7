"""Scans, filters, projections, periods and metric arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.catalog.base import (
    DURATION_OF_PRIORITY,
    DURATION_SQL,
    HEAD_SQL,
    NEW_TYPE_SQL,
    TYPE_OF_PRIORITY,
    TYPE_SQL,
    query,
    table,
    yyyymmdd,
)
from panelkit.functions import columns as C
from panelkit.functions import periods as P
from panelkit.session import staging_path
from panelkit.sources import files


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = staging_path(spark, "customer-csv")
    customer.write.option("header", True).option("compression", "gzip").csv(path)
    return files.flat_csv(spark, path, customer.schema)


@query(
    """SELECT o_orderkey, o_totalprice, o_orderstatus, NULL::DOUBLE AS o_margin FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, o_totalprice / 2 FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, NULL FROM orders WHERE o_orderstatus = 'P'"""
)
def parquet_stack(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    paths = []
    for status in ("F", "O", "P"):
        part = orders.filter(F.col("o_orderstatus") == status)
        if status == "O":
            part = part.withColumn("o_margin", F.col("o_totalprice") / 2)
        paths.append(staging_path(spark, f"status-{status}"))
        part.write.parquet(paths[-1])
    return files.stacked(spark, paths, provenance=None)


DELIVERY_OF_PRIORITY = {
    "1-URGENT": "diapers_br_allshops.parquet",
    "2-HIGH": "shampoo_allshops.parquet",
    "3-MEDIUM": "femcare_tot.parquet",
    "4-NOT SPECIFIED": "deterg_allshops.parquet",
    "5-LOW": "haircond_allshops.parquet",
}


@query(
    """SELECT o_orderkey,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'MALE B&R' WHEN '2-HIGH' THEN 'Shampoos'
        WHEN '4-NOT SPECIFIED' THEN 'Laundry Detergents' ELSE 'Hair Conditioners' END AS category,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'delivery=diapers_br_allshops.parquet'
        WHEN '2-HIGH' THEN 'delivery=shampoo_allshops.parquet'
        WHEN '4-NOT SPECIFIED' THEN 'delivery=deterg_allshops.parquet'
        ELSE 'delivery=haircond_allshops.parquet' END AS folder
    FROM orders WHERE o_orderpriority <> '3-MEDIUM'"""
)
def file_category(spark, sf_dir):
    """Deliveries found by pattern in nested folders, totals-only ones skipped by name."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    named = orders.withColumn("delivery", C.map_value(DELIVERY_OF_PRIORITY, F.col("o_orderpriority")))
    path = staging_path(spark, "deliveries")
    named.write.partitionBy("delivery").parquet(path)
    found = files.deliveries(spark, path, "*.parquet", schema="o_orderkey long, o_orderpriority string")
    folder = F.split_part("file", F.lit("/"), F.lit(1))
    return found.select("o_orderkey", files.category_of(folder).alias("category"), folder.alias("folder"))


@query("SELECT o_orderkey, 'status=' || o_orderstatus AS folder, true AS in_file FROM orders")
def file_provenance(spark, sf_dir):
    """Folder and file every row was read from."""
    path = staging_path(spark, "by-status")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    orders.write.partitionBy("status").parquet(path)
    found = files.deliveries(spark, path, schema="o_orderkey long", skip=None)
    name = F.split_part("file", F.lit("/"), F.lit(2))
    return found.select(
        "o_orderkey", F.split_part("file", F.lit("/"), F.lit(1)).alias("folder"), name.startswith("part-").alias("in_file")
    )


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Feminine Care' WHEN 'O' THEN 'Shampoos'
      ELSE 'Laundry Detergents' END AS category,
      CASE o_orderstatus WHEN 'F' THEN 'femcare' WHEN 'O' THEN 'shampoo' ELSE 'deterg' END AS name
    FROM orders"""
)
def file_name_token(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    token = C.map_value({"F": "femcare", "O": "shampoo", "P": "deterg"}, F.col("o_orderstatus"))
    name = F.concat(token, F.lit("_allshops.parquet"))
    return orders.select("o_orderkey", files.category_of_first_token(name).alias("category"), token.alias("name"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def dim_load(spark, sf_dir):
    path = staging_path(spark, "nation-dictionary")
    table(spark, sf_dir, "nation").toDF("N_NationKey", "N_Name", "N_RegionKey").write.parquet(path)
    return files.dictionary(spark, path)


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0")
def positive_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return C.keep_positive(lines, "l_discount")


@query("SELECT p_partkey, p_type, p_size FROM part WHERE NOT (p_type = 'STANDARD' AND p_size IN (1, 5, 7))")
def deny_list(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    return C.drop_ids(part, "p_size", [1, 5, 7], F.col("p_type") == "STANDARD")


@query("SELECT c_custkey, CASE c_nationkey WHEN 3 THEN 4 WHEN 8 THEN 9 ELSE c_nationkey END AS c_nationkey FROM customer")
def reparent(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_nationkey").alias("node")
    )
    return C.reparent(customer, "node", "c_nationkey", {3: 4, 8: 9}).drop("node")


def _old_periods(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        C.map_value(TYPE_OF_PRIORITY, F.col("o_orderpriority")).alias("period_type"),
        yyyymmdd("o_orderdate").alias("period_end"),
    )
    return P.with_old_period_label(P.with_date_parts(orders, "period_end"), "period_type")


@query(
    f"""SELECT o_orderkey, {TYPE_SQL} AS period_type, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS period_end,
      strftime(o_orderdate, '%Y') AS "year", strftime(o_orderdate, '%m') AS "month",
      strftime(o_orderdate, '%b') AS month_name,
      CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {HEAD_SQL} || ': ' || strftime(o_orderdate, '%Y (%m) %b') END
        AS period_lbl
    FROM orders"""
)
def old_period_label(spark, sf_dir):
    return _old_periods(spark, sf_dir)


@query("SELECT DISTINCT 'Weekly' AS period_type FROM orders WHERE o_orderpriority = '5-LOW'")
def unknown_period_types(spark, sf_dir):
    return P.unknown_period_types(_old_periods(spark, sf_dir), "period_type")


def new_periods(spark, sf_dir):
    """Orders as new-format rows: duration, year and month, labelled."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        C.map_value(DURATION_OF_PRIORITY, F.col("o_orderpriority")).alias("duration"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    return P.with_new_period_labels(orders)


NEW_PERIODS_SQL = f"""SELECT o_orderkey, CAST({DURATION_SQL} AS INTEGER) AS duration,
      CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month",
      {NEW_TYPE_SQL} AS time_period_type, {HEAD_SQL} || ': ' || strftime(o_orderdate, '%b %Y') AS period_lbl,
      {HEAD_SQL} || ': ' || strftime(o_orderdate, '%Y (%m) %b') AS label_num
    FROM orders"""


@query(NEW_PERIODS_SQL)
def new_period_labels(spark, sf_dir):
    return new_periods(spark, sf_dir)


@query(
    """SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS "2__time_balance" FROM customer"""
)
def rename_normalise(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    wide = customer.toDF("Customer Key", "Customer Name", "2+ Time Balance")
    return C.rename(C.snake_headers(wide, plus=True), {"customer_key": "customer_id", "absent": "x"})


@query("SELECT c_custkey AS customer, c_acctbal AS balance, c_name FROM customer")
def dictionary_rename(spark, sf_dir):
    """Columns renamed by a table of delivered and wanted names; the wanted ones come first."""
    customer = table(spark, sf_dir, "customer")
    legends = spark.createDataFrame(
        [("c_custkey", "customer"), ("c_acctbal", "balance"), (None, "note")], "mask string, colum string"
    )
    renamed = C.rename(customer, files.metric_renames(legends))
    wanted = files.wanted_columns(customer.selectExpr("1 AS Customer", "2 AS Balance"), extra=["c_name", "file"])
    return C.keep_present(renamed, wanted)


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Buildings' WHEN 'MACHINERY' THEN 'Machines'
      ELSE c_mktsegment END AS c_mktsegment, lower(c_name) AS c_name FROM customer"""
)
def recode_values(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")
    recoded = C.recode(customer, "c_mktsegment", {"BUILDING": "Buildings", "MACHINERY": "Machines"})
    return C.fold_case(recoded, "c_name")


@query(
    """SELECT p_partkey, p_type, CASE p_type WHEN 'PROMO' THEN 'Promotion' WHEN 'SMALL' THEN 'Little' END AS segment
    FROM part"""
)
def default_column(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return C.default_by(part, "segment", "p_type", {"PROMO": "Promotion", "SMALL": "Little"})


@query(
    """SELECT n_nationkey, 1 AS shop_code, 1 AS shop_lvls, 'national' AS channel, n_nationkey AS shop_hier FROM nation"""
)
def constants(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    fixed = C.with_constants(nation, {"shop_code": 1, "shop_lvls": 1, "channel": "national"})
    return C.copy_codes(fixed, {"shop_hier": "n_nationkey"})


@query("SELECT l_orderkey, l_quantity, l_shipdate::DATE AS l_shipdate FROM lineitem")
def project_allowlist(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").drop("l_comment")
    wanted = C.keep_present(lines, ["l_orderkey", "l_missing", "l_quantity", "l_shipdate"])
    return C.cast_columns(wanted, {"l_shipdate": "date"})


@query(
    """SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_retailprice, p_partkey AS part_hier FROM part"""
)
def cast_and_copy(spark, sf_dir):
    """Metric and key columns chosen by type, casts and a copied code."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    part = part.select(*C.key_columns(part), *C.metric_columns(part)).drop("p_brand")
    return C.copy_codes(C.cast_columns(part, {"p_size": "long"}), {"part_hier": "p_partkey"})


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 AS l_extendedprice, NULL::DOUBLE AS l_tax
    FROM lineitem"""
)
def scale_and_blank(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    return C.blank(C.to_thousands(lines, ["l_extendedprice"]), ["l_tax"])


@query(
    """SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * l_discount / 7 * 1000, 0) / 1000 AS amount,
      round_even(l_extendedprice * l_tax / 3 * 1000000, 0) / 1000000 AS fine FROM lineitem"""
)
def round_metrics(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") * F.col("l_discount") / 7).alias("amount"),
        (F.col("l_extendedprice") * F.col("l_tax") / 3).alias("fine"),
    )
    return C.round_metrics(C.round_metrics(lines, ["amount"]), ["fine"], 6)
