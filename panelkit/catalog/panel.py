"""Deliveries of both formats and their dictionaries, made from the driver tables.

Part types stand in for categories, brand and size class for the product tree, customer
segments for buyer groups, order years for periods and order statuses for shops.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.catalog.base import cents, table
from panelkit.fixed import CATEGORY_CODES
from panelkit.functions.columns import map_value
from panelkit.operators.union import union_all
from panelkit.plans.new_format import Dictionaries
from panelkit.session import side_by_side, stage

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
CATEGORIES = [
    "Diapers", "MALE B&R", "Hair Conditioners", "Shampoos", "Feminine Care", "Laundry Detergents",
]
FILES = ["diapers", "MALE B&R", "haircond", "shampoo", "femcare", "deterg"]
ROOTS = [label.removeprefix("0. ") for label in CATEGORY_CODES]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SHOPS = {"F": "Ok Hyper", "O": "Perekryostok", "P": "Corner shop"}

# The product dictionary lists products from the highest id down.
TOP_CODE = 10_000_000


def _pick(values, number):
    return map_value({i: v for i, v in enumerate(values, 1)}, number)


def cells(spark, sf_dir):
    """Purchases summed by category, brand, size class, buyer segment, status and year."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("st"), F.year("o_orderdate").alias("y")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("seg"))
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        map_value({t: i for i, t in enumerate(TYPES, 1)}, F.col("p_type")).alias("k"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("long").alias("b"),
        F.floor(F.col("p_size") / 10).alias("s"),
    )
    rows = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
    )
    summed = rows.groupBy("k", "b", "s", "seg", "st", "y").agg(
        F.count_if(F.col("l_discount") > 0).alias("occasions"),
        F.count_if(F.col("l_returnflag") == "R").alias("buyers"),
        F.sum(cents("l_extendedprice")).alias("spend"),
        F.sum(F.col("l_quantity").cast("long")).alias("volume"),
    )
    return stage(summed, "cells")


def _product(level):
    """Node id, parent id and label of a cell's product at a tree level."""
    ids = [
        F.col("k") * 1_000_000,
        F.col("k") * 1_000_000 + F.col("b") * 1000,
        F.col("k") * 1_000_000 + F.col("b") * 1000 + F.col("s") + 1,
    ]
    brand = F.concat(F.lit("Brand "), F.col("b").cast("string"))
    labels = [_pick(ROOTS, F.col("k")), brand, F.concat(brand, F.lit(" class "), F.col("s").cast("string"))]
    feature = [F.lit(0), F.lit(0), F.col("s") + 1]
    return F.struct(
        ids[level].cast("long").alias("pid"),
        ids[max(level - 1, 0)].cast("long").alias("pparent"),
        labels[level].alias("plabel"),
        F.lit(level).alias("depth"),
        feature[level].cast("long").alias("feature"),
    )


def _buyer(level):
    number = F.array_position(F.array(*map(F.lit, SEGMENTS)), F.col("seg")) + 9
    ids = [F.lit(1), F.lit(2), number]
    labels = [F.lit("TOTAL DEMOGRAPHICS"), F.lit("Market segment"), F.col("seg")]
    return F.struct(
        ids[level].cast("long").alias("bid"),
        ids[max(level - 1, 0)].cast("long").alias("bparent"),
        labels[level].alias("blabel"),
    )


def _summed(df, keys):
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in ("occasions", "buyers", "spend", "volume")])


def old_raw(base):
    """An old-format flat file: every product node by every buyer group by year."""
    rows = base.withColumn("p", F.explode(F.array(*map(_product, range(3)))))
    rows = rows.withColumn("g", F.explode(F.array(*map(_buyer, range(3)))))
    rows = _summed(rows.select("*", "p.*", "g.*"), ["k", "pid", "pparent", "plabel", "bid", "bparent", "blabel", "y"])
    return rows.select(
        _pick(CATEGORIES, F.col("k")).alias("Category Name"),
        F.col("plabel").alias("Product Name"),
        F.col("pid").alias("Vendor Product ID"),
        F.col("pparent").alias("Parent Product ID"),
        F.concat(F.lit("All "), _pick(CATEGORIES, F.col("k"))).alias("Segment"),
        F.col("bid").alias("Buyer Group ID"),
        F.col("bparent").alias("Buyer Group Parent ID"),
        F.col("blabel").alias("Buyer Group Name"),
        F.lit("MAT/ 52 we").alias("Time Period Type"),
        (F.col("y") * 10000 + 1231).cast("long").alias("Time Period End Date"),
        F.col("occasions").cast("double").alias("Occasions"),
        F.col("buyers").cast("double").alias("Buying Households"),
        (F.col("spend") / 100).alias("Spend Local Currency"),
        F.col("volume").cast("double").alias("Volume SU"),
    )


def new_raw(base):
    """New-format deliveries: brands and categories by buyer group, shop and year. The files
    of 1998 came twice, and two categories have no segment."""
    rows = base.withColumn("p", F.explode(F.array(*map(_product, range(2)))))
    rows = rows.withColumn("g", F.explode(F.array(_buyer(0), _buyer(2))))
    shop = F.array(F.lit("National"), map_value(SHOPS, F.col("st")))
    rows = rows.withColumn("shop", F.explode(shop))
    rows = _summed(rows.select("*", "p.*", "g.*"), ["k", "plabel", "blabel", "shop", "y"])
    category = _pick(CATEGORIES, F.col("k"))
    segment = F.when(~F.col("k").isin(4, 5), F.concat(F.lit("All "), category))
    folders = F.when(F.col("y") == 1998, F.array(F.lit("late"), F.lit("first"))).otherwise(F.array(F.lit("first")))
    rows = rows.withColumn("folder", F.explode(folders))
    return rows.select(
        category.alias("category"),
        F.col("plabel").alias("Category Name"),
        F.when(F.col("blabel") == "TOTAL DEMOGRAPHICS", "Total Population")
        .otherwise(F.initcap("blabel"))
        .alias("Buyer Group Name"),
        segment.alias("Segment"),
        F.col("shop").alias("position_name_shop"),
        F.lit(12).alias("duration"),
        F.col("y").alias("year"),
        F.lit(12).alias("month"),
        F.concat("folder", F.lit("/"), _pick(FILES, F.col("k")), F.lit("_allshops.parquet")).alias("file"),
        F.col("buyers").cast("double").alias("Buying HH"),
        (F.col("spend") / 700).alias("Spend Local Currency"),
        (F.col("volume").cast("double") / 7).alias("Volume SU"),
    )


def dictionaries(base):
    """Products, buyer groups, segments, shops and period types."""
    rows = base.select("k", F.explode(F.array(*map(_product, range(3)))).alias("p")).select("k", "p.*").distinct()
    products = rows.select(
        _pick(CATEGORIES, F.col("k")).alias("category name"),
        F.col("plabel").alias("product name"),
        F.col("pid").alias("vendor product id"),
        F.col("plabel").alias("full_label"),
        (F.lit(TOP_CODE) - F.col("pid")).alias("product_code"),
        F.col("k").alias("category_code"),
        F.concat(F.lit("feature "), F.col("feature").cast("string")).alias("feature"),
        F.col("feature").alias("feature_code"),
        F.concat(F.lit("0. "), F.col("plabel")).alias("product_hier"),
        F.col("depth").alias("product_lvls"),
    )
    groups = base.select(F.explode(F.array(*map(_buyer, range(3)))).alias("g")).select("g.*").distinct()
    total = F.col("bid") == 1
    demo = groups.select(
        F.col("bid").alias("buyer group id"),
        F.col("blabel").alias("buyers_gr_label"),
        F.col("bid").alias("demo_code"),
        F.concat(F.lit("0. "), F.col("blabel")).alias("demo_hier"),
        F.when(total, 0).when(F.col("bid") == 2, 1).otherwise(2).alias("demo_lvls"),
        F.when(total, 1).otherwise(2).cast("long").alias("socdem_gr"),
    )
    categories = base.select("k").distinct()
    named = F.concat(F.lit("All "), _pick(CATEGORIES, F.col("k")))
    segments = union_all(
        [
            categories.select(named.alias("segment"), F.col("k").alias("segment_code")),
            categories.filter("k = 4").select(F.lit("Shampoos").alias("segment"), F.lit(14).alias("segment_code")),
            categories.filter("k = 5").select(F.lit("Total Feminine Care").alias("segment"), F.lit(15).alias("segment_code")),
        ]
    )
    statuses = base.select("st").distinct()
    place = map_value({"F": 2, "O": 3, "P": 4}, F.col("st"))
    spelled = map_value({"F": "OK Hyper", "O": "Perekrestok", "P": "Corner shop"}, F.col("st"))
    shops = union_all(
        [
            statuses.agg(F.lit("National").alias("position_name_shop"), F.lit(1).alias("shop_code")),
            statuses.select(spelled.alias("position_name_shop"), place.alias("shop_code")),
        ]
    ).select(
        "*",
        F.when(F.col("shop_code") == 1, 1).otherwise(2).alias("shop_lvls"),
        F.when(F.col("shop_code") == 1, 1).otherwise(5).alias("channel_code"),
        F.when(F.col("shop_code") == 1, "National").otherwise("Shops").alias("channel_type"),
    )
    types = base.agg(F.lit("MAT/ 52 we").alias("time_period_type"), F.lit(2).alias("time_period_code"))
    tables = zip(Dictionaries._fields, (products, demo, segments, shops, types))
    return Dictionaries(*side_by_side(*[lambda t=t, n=n: stage(t, n) for n, t in tables]))


def first_registry(base):
    """The periods before 1998: one year-long period each."""
    years = base.filter("y < 1998").select("y").distinct()
    year = F.col("y").cast("string")
    return years.select(
        F.concat(F.lit("MAT: Dec "), year).alias("period_lbl"),
        F.concat(F.lit("MAT: "), year, F.lit(" (12) Dec")).alias("label_num"),
        F.lit("2024-01-01").alias("date_added"),
        (F.col("y") - 1900).alias("period_code"),
        F.lit(1).alias("period_batch"),
    )
