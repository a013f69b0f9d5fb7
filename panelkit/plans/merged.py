"""Old and new facts in one table: metric backfill, precedence, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from panelkit import fixed
from panelkit.operators.shares import with_shares
from panelkit.operators.union import backfill, first_by_priority
from panelkit.session import stage

SHARE_KEYS = [
    "product_lvls", "category", "shop_code", "shop_lvls", "time_period_type", "year", "period_lbl",
    "product_hier", "products", "features", "cat_segment",
]


def merge(
    old: DataFrame, new: DataFrame, keys: Sequence[str] = SHARE_KEYS, validate: bool = True
) -> DataFrame:
    """Old facts, their unusable metrics taken from the new ones, then the new facts whose
    key is not among the old ones; shares on top."""
    filled = backfill(old, new, fixed.UNUSABLE_OLD_METRICS, validate=validate)
    union = stage(first_by_priority([filled, new]), "merged")
    return with_shares(union, [k for k in keys if k in union.columns])
