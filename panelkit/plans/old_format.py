"""Old-format flat files: trees, labels and recoding, for all categories in one plan.

The category is a column throughout, so rules for one category are conditions and not
a loop over files.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import fixed
from panelkit.functions import columns as C
from panelkit.functions.periods import with_date_parts, with_old_period_label
from panelkit.operators import hierarchy as H
from panelkit.operators.lookup import inverse_map, measure_all, miss_counts, require_all_unique, require_unique, soft_map, strict_map
from panelkit.operators.quality import Findings
from panelkit.operators.skew import BROADCAST_BYTES, HotKeys
from panelkit.operators.union import distinct_late
from panelkit.session import side_by_side, stage

# Every category has its own trees: siblings a category lacks take no rank there.
SCOPE = ["Category Name"]
PERIODS = ["Time Period Type", "year", "period_lbl"]
#: Text columns that belong together: products, buyer groups and periods are few beside the facts.
NAMES = [[*SCOPE, "Product Name", "Segment"], ["Buyer Group Name"], PERIODS]


class Prepared(NamedTuple):
    facts: DataFrame
    category_tree: DataFrame
    products: DataFrame
    buyers: DataFrame


def cleaned(raw: DataFrame, category: str = "Category Name") -> DataFrame:
    """Rows with purchases, the detergent tree put right, periods labelled."""
    detergent = F.col(category) == fixed.DETERGENT_CATEGORY
    df = C.keep_positive(raw, "Occasions")
    df = C.reparent(df, "Vendor Product ID", "Parent Product ID", fixed.DETERGENT_PARENTS, detergent)
    df = C.drop_ids(df, "Vendor Product ID", fixed.DETERGENT_DROPPED, detergent)
    return with_old_period_label(with_date_parts(df, "Time Period End Date"), "Time Period Type")


def product_nodes(
    facts: DataFrame, groups: DataFrame, order=None, strict: bool = True, findings: Findings | None = None
) -> DataFrame:
    """The product tree of the facts, labelled and ordered by the product dictionary."""
    edges = H.edges_from_facts(
        facts, "Vendor Product ID", "Parent Product ID", "Product Name", order, SCOPE
    ).drop("label")
    entry = F.struct(F.col("full_label").alias("label"), F.col("product_code").alias("order"))
    listed = groups.select("vendor product id", entry.alias("entry"))
    edges = strict_map(edges, "id", listed, "vendor product id", "entry", "entry")
    edges = edges.select(*SCOPE, "id", "parent", "entry.*", "conflict")
    return H.walk(edges, strict, SCOPE, findings=findings, step="products")


def buyer_nodes(
    facts: DataFrame, demo: DataFrame, order=None, strict: bool = True, findings: Findings | None = None
) -> DataFrame:
    """The buyer group tree of the facts, ordered by the demographic dictionary."""
    edges = H.edges_from_facts(
        facts, "Buyer Group ID", "Buyer Group Parent ID", "Buyer Group Name", order, SCOPE
    )
    edges = strict_map(edges, "id", demo, "buyer group id", "demo_code", "order")
    return H.walk(edges, strict, SCOPE, findings=findings, step="buyer groups")


def prepare(
    raw: DataFrame,
    groups: DataFrame,
    demo: DataFrame,
    metrics: list[str] | None = None,
    order=None,
    strict: bool = True,
    limit: int = BROADCAST_BYTES,
    findings: Findings | None = None,
) -> Prepared:
    """Facts with hierarchy labels, depths, feature, category and demographic group.

    ``raw`` is read several times (trees, levels in use, result), so it should be files. With ``findings`` the facts are
    written here, and the findings are told of both trees (see ``walk``), missing metrics, rows, repeated rows, missing values,
    facts outside the trees and facts whose period type has no label.
    """
    if findings:
        findings.missing("prepared", raw, metrics or fixed.OLD_METRICS)
    metrics = metrics or [m for m in fixed.OLD_METRICS if m in raw.columns]
    facts = cleaned(raw)
    products, buyers = side_by_side(
        lambda: H.with_levels(product_nodes(facts, groups, order, strict, findings), "level_"),
        lambda: H.with_levels(buyer_nodes(facts, demo, order, strict, findings), "demo_", width=2),
    )
    product_levels = [c for c in products.columns if c.startswith("level_") and not c.endswith("_code")]

    # every id comes once in the trees (checked by the walk); their bytes bound those of the sides made from them
    measured, (_, group_bytes, _) = side_by_side(
        lambda: measure_all({"products": products, "buyers": buyers}),
        lambda: require_unique(groups, ["vendor product id"], "products"),
    )
    known = {name: {"validate": False, "limit": limit, "measured": n} for name, n in measured.items()}
    named = facts.select("Category Name", "Vendor Product ID", "Product Name").distinct()
    side = products.select(*SCOPE, "id", F.col("depth").alias("product_lvls"), *product_levels)
    tree = H.category_tree(
        H.attach(named, side, "Vendor Product ID", SCOPE, **known["products"]),
        ["Category Name", "Vendor Product ID", "Product Name", "product_lvls", *product_levels],
    )

    # Names are long and repeat; only their numbers and the metrics are compared and shuffled.
    copies = "__copies" if findings else None
    joined = distinct_late(
        facts.select("Vendor Product ID", "Buyer Group ID", *[c for own in NAMES for c in own], *metrics), NAMES, limit, copies
    )
    hot = HotKeys(facts, [*SCOPE, "Vendor Product ID"], ["Vendor Product ID"], [*SCOPE, "Buyer Group ID"])
    # Of the levels only the category and the demographic group stay in the facts, so no
    # other level is attached and none has to be tested for being redundant.
    side = products.select(
        *SCOPE,
        "id",
        F.col("depth").alias("product_lvls"),
        F.col("hier").alias("product_hier"),
        F.col("level_0").alias("category"),
        F.col("level_0_code").alias("category_code"),
    )
    joined = H.attach(joined, side, "Vendor Product ID", SCOPE, hot=hot, **known["products"])
    joined = strict_map(
        joined, "Vendor Product ID", groups, "vendor product id", "feature", "feature",
        limit=limit, measured=group_bytes, hot=hot,
    )
    side = buyers.select(
        *SCOPE,
        "id",
        F.col("depth").alias("demo_lvls"),
        F.col("hier").alias("demo_hier"),
        F.col("demo_1").alias("socdem_gr"),
        F.col("demo_1_code").alias("socdem_gr_code"),
    )
    joined = H.attach(joined, side, "Buyer Group ID", SCOPE, hot=hot, **known["buyers"])
    # a buyer group that no root reaches has no depth; its facts stay
    result = joined.filter(F.col("demo_lvls").isNull() | (F.col("demo_lvls") != 1)).drop("Category Name")
    if findings:
        also = {
            "facts outside the product tree": F.col("product_lvls").isNull(),
            "facts outside the buyer group tree": F.col("demo_lvls").isNull(),
            "facts without period label": F.col("period_lbl").isNull(),
        }
        result = findings.staged(result, "prepared", copies, also)
    return Prepared(result, tree, products, buyers)


def recode(
    prepared: DataFrame, groups: DataFrame, demo: DataFrame, segments: DataFrame,
    periods: DataFrame, types: DataFrame, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Labels and ids of prepared facts as codes, metrics in thousands, national shop.

    If some dictionary is too large to broadcast, the facts are written first: the hot keys of all
    lookups are found in one pass over that table, and no join before them runs twice.
    """
    unique = {"products": (groups, ["vendor product id"]), "buyer groups": (demo, ["buyer group id"])}
    others = {"segments": segments, "periods": periods, "types": types}
    checked, measured = side_by_side(lambda: require_all_unique(unique), lambda: measure_all(others))
    size = checked | measured
    if max(size.values()) > limit:
        prepared = stage(prepared, "prepared")
    df = C.recode(prepared, "Time Period Type", fixed.OLD_PERIOD_SPELLING)
    keyed = df.withColumnRenamed("Time Period Type", "time_period_type")
    hot = HotKeys(
        keyed, ["Vendor Product ID"], ["feature"], ["Segment"], ["socdem_gr_code"], ["Buyer Group ID"],
        ["time_period_type"], ["period_lbl"],
    )

    def options(name):
        return {"limit": limit, "measured": size[name], "hot": hot}

    product = (groups, "vendor product id", "product_code", "products")
    df = soft_map(df, "Vendor Product ID", *product, **options("products"))
    df = inverse_map(df, "feature", groups, "feature_code", "feature", "features", **options("products"))
    df = inverse_map(df, "Segment", segments, "segment_code", "segment", "cat_segment", **options("segments"))
    df = df.withColumn("category", C.map_value(fixed.CATEGORY_CODES, F.col("category")))
    group = (demo, "buyer group id", "demo_code")
    df = soft_map(df, "socdem_gr_code", *group, "socdem_gr", **options("buyer groups"))
    df = soft_map(df, "Buyer Group ID", *group, "demo_groups", **options("buyer groups"))
    df = C.copy_codes(df, {"product_hier": "products", "demo_hier": "demo_groups"})
    df = df.drop(
        "socdem_gr_code", "category_code", "Vendor Product ID", "Product Name", "feature", "Segment",
        "Buyer Group ID", "Buyer Group Name", "Projected Shoppers", "Panel Sample Size",
    )
    df = C.snake_headers(df, plus=True)
    df = C.to_thousands(df, [m for m in fixed.METRICS_IN_UNITS if m in df.columns])
    df = C.cast_columns(df, {"year": "int", "product_lvls": "int", "demo_lvls": "int"})
    kind = (types, "time_period_code", "time_period_type", "time_period_type")
    df = inverse_map(df, "time_period_type", *kind, **options("types"))
    df = inverse_map(df, "period_lbl", periods, "period_code", "label_num", "period_lbl", **options("periods"))
    df = C.with_constants(
        df, {"shop_code": fixed.NATIONAL, "shop_lvls": 1, "channel_code": fixed.NATIONAL}
    )
    return C.blank(df, [m for m in fixed.UNUSABLE_OLD_METRICS if m in df.columns])


def recode_misses(recoded: DataFrame) -> DataFrame:
    """Rows without a code, per recoded variable."""
    return miss_counts(
        recoded,
        ["products", "features", "cat_segment", "category", "socdem_gr", "demo_groups",
         "time_period_type", "period_lbl"],
    )
