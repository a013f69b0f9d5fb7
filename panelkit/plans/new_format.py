"""New-format deliveries: classify, look up codes, label periods, clean and add shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import fixed
from panelkit.functions import columns as C
from panelkit.functions.periods import with_new_period_labels
from panelkit.operators.lookup import adaptive_lookup, lookup, require_all_unique
from panelkit.operators.quality import Findings
from panelkit.operators.registry import PERIOD_KEYS, attach_periods
from panelkit.operators.shares import with_shares
from panelkit.operators.skew import BROADCAST_BYTES, HotKeys
from panelkit.operators.union import distinct_without
from panelkit.session import stage
from panelkit.sources.files import base_name, category_of


class Dictionaries(NamedTuple):
    """Dictionary tables, headers in lower case."""

    products: DataFrame
    demo: DataFrame
    segments: DataFrame
    shops: DataFrame
    types: DataFrame


def classified(df: DataFrame, provenance: str = "file") -> DataFrame:
    """Deliveries with lower-case headers and the category their file name tells."""
    df = C.lower_headers(df).drop("category")
    df = C.rename(df, {"category name": "product name", "buyer group name": "buyers_gr_label"})
    return df.withColumn("category name", category_of(base_name(F.col(provenance))))


LOOKUP_KEYS = (["category name", "product name"], ["buyers_gr_label"], ["segment"], ["position_name_shop"])


def spelled(df: DataFrame) -> DataFrame:
    """Classified deliveries with every lookup key in the spelling of the dictionaries."""
    df = C.fold_case(C.recode(df, "buyers_gr_label", fixed.BUYER_SPELLING), "buyers_gr_label")
    df = C.default_by(df, "segment", "category name", fixed.DEFAULT_SEGMENTS)
    detergent = F.col("category name") == fixed.DETERGENT_CATEGORY
    df = C.recode(df, "segment", fixed.DETERGENT_SEGMENT_SPELLING, detergent)
    df = C.recode(df, "segment", fixed.SEGMENT_SPELLING)
    return C.recode(df, "position_name_shop", fixed.SHOP_SPELLING)


def coded(
    df: DataFrame,
    dims: Dictionaries,
    renames: Mapping[str, str],
    wanted: Sequence[str],
    adaptive: bool = False,
    limit: int = BROADCAST_BYTES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Labels of classified deliveries looked up in the dictionaries.

    ``adaptive`` is the older product rule: by short name if all are known, else by full label.
    Hot keys of all lookups too large to broadcast are found on the deliveries, before the first of them;
    ``hot`` knows them already if more lookups are to come.
    """
    income = df.columns
    buyers = C.fold_case(dims.demo, "buyers_gr_label")
    checked = {
        "buyer groups": (buyers, ["buyers_gr_label"]),
        "segments": (dims.segments, ["segment"]),
        "shops": (dims.shops, ["position_name_shop"]),
    }
    if not adaptive:
        checked["products"] = (dims.products, ["category name", "full_label"])
    size = require_all_unique(checked)

    df = spelled(df)
    options = {"limit": limit, "hot": hot or HotKeys(df, *LOOKUP_KEYS)}
    if adaptive:
        df = adaptive_lookup(
            df, dims.products, "product name", ["product name", "full_label"], ["category name"], **options
        )
    else:
        products = dims.products.drop("product name")
        on = {"category name": "category name", "product name": "full_label"}
        df = lookup(df, products, on, measured=size["products"], **options)
    df = C.rename(
        df, {"product_code": "products", "category_code": "category", "feature_code": "features"}
    )
    df = C.copy_codes(df, {"product_hier": "products"})

    df = lookup(df, buyers, ["buyers_gr_label"], measured=size["buyer groups"], **options)
    df = C.rename(df, {"demo_code": "demo_groups"})
    df = C.copy_codes(df, {"demo_hier": "demo_groups"})

    df = lookup(df, dims.segments, ["segment"], measured=size["segments"], **options)
    df = C.rename(df, {"segment_code": "cat_segment"})

    df = lookup(df, dims.shops, ["position_name_shop"], measured=size["shops"], **options)

    df = C.rename(C.snake_headers(df), renames)
    return C.keep_present(df, [*wanted, "duration", "month", *income])


def share_keys(df: DataFrame, demo_columns: Sequence[str], by_file: bool = True) -> list[str]:
    """The dimensions a total must share with a row: all but the demographic ones."""
    skipped = {*demo_columns, "demo_groups", "demo_hier", "date_added"} | (set() if by_file else {"file"})
    return [c for c in C.key_columns(df) if c not in skipped]


def clean(
    df: DataFrame, wanted: Sequence[str], digits: int = 3, files: DataFrame | None = None, copies: str | None = None
) -> DataFrame:
    """Wanted columns and metrics, metrics rounded, each content once. ``files`` may give the file names at less cost.

    ``copies`` names a column that counts the delivered rows of each content.
    """
    metrics = C.metric_columns(df)
    df = C.keep_present(df, [*wanted, *metrics])
    return distinct_without(C.round_metrics(df, metrics, digits), "file", files=files, copies=copies)


def process(
    raw: DataFrame,
    dims: Dictionaries,
    registry: DataFrame,
    renames: Mapping[str, str],
    wanted: Sequence[str],
    by_file: bool = True,
    strict: bool = True,
    adaptive: bool = False,
    limit: int = BROADCAST_BYTES,
    findings: Findings | None = None,
) -> DataFrame:
    """From deliveries to coded, clean facts with shares.

    ``registry`` must already hold the periods of the deliveries: see ``labelled`` and
    ``register_periods``, whose result is written before this plan reads it. ``findings`` are told the clean rows,
    the repeated ones left out, missing values of each column, and wanted columns that no delivery has.
    """
    df = files = classified(raw)
    hot = HotKeys(with_new_period_labels(spelled(df), strict), *LOOKUP_KEYS, *PERIOD_KEYS)
    df = coded(df, dims, renames, wanted, adaptive, limit, hot)
    df = attach_periods(with_new_period_labels(df, strict), registry, dims.types, limit, hot)
    # The totals and the facts both read the clean rows, so they are written once.
    if findings:
        findings.missing("clean", df, wanted)
        df = findings.staged(clean(df, wanted, files=files, copies="__copies"), "clean", "__copies")
    else:
        df = stage(clean(df, wanted, files=files), "clean")
    return with_shares(df, share_keys(df, C.lower_headers(dims.demo).columns, by_file), limit=limit)


def labelled(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The periods of deliveries, labelled: the input of ``register_periods``."""
    return with_new_period_labels(C.lower_headers(raw).select("duration", "year", "month"), strict)
