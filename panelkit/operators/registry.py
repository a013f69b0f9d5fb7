"""The period registry: detection, numbering and attachment of periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.columns import rename
from panelkit.operators.lookup import lookup, require_all_unique, require_unique
from panelkit.operators.skew import BROADCAST_BYTES, HotKeys, sized_join
from panelkit.operators.union import union_all
from panelkit.session import side_by_side


def new_periods(labelled: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct periods whose display label the registry lacks; a period without label is none."""
    named = labelled.filter(F.col("period_lbl").isNotNull() & F.col("label_num").isNotNull())
    seen = named.select("duration", "year", "month", "period_lbl", "label_num").distinct()
    return sized_join(seen, registry.select("period_lbl").distinct(), ["period_lbl"], "left_anti")


def register_periods(labelled: DataFrame, registry: DataFrame, today: str) -> DataFrame:
    """The registry with the unseen periods added as one batch.

    New periods get the codes after the highest one, ordered by year, month and duration;
    registered codes never change. The caller writes the result as a new version.
    """
    last = registry.agg(
        F.coalesce(F.max("period_code"), F.lit(0)).alias("code"),
        F.coalesce(F.max("period_batch"), F.lit(0)).alias("batch"),
    )
    _, state, added = side_by_side(
        lambda: require_unique(registry, ["period_code"], "period registry"),
        last.first,
        lambda: new_periods(labelled, registry),
    )
    # At most four durations in twelve months of each year, so one task can number them.
    number = F.row_number().over(Window.orderBy("year", "month", "duration"))
    added = added.select(
        "period_lbl",
        "label_num",
        F.lit(today).alias("date_added"),
        (number + state.code).cast(registry.schema["period_code"].dataType).alias("period_code"),
        F.lit(state.batch + 1).cast(registry.schema["period_batch"].dataType).alias("period_batch"),
    )
    return union_all([registry.select(added.columns), added])


PERIOD_KEYS = (["period_lbl", "label_num"], ["time_period_type"])


def attach_periods(
    labelled: DataFrame,
    registry: DataFrame,
    types: DataFrame,
    limit: int = BROADCAST_BYTES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Facts with the codes of their period and period type in place of the labels.

    ``hot`` knows the hot ``PERIOD_KEYS`` of the facts, if lookups came before.
    """
    by_label, by_type = PERIOD_KEYS
    size = require_all_unique({"periods": (registry, by_label), "period types": (types, by_type)})
    coded = lookup(labelled, registry.drop("period_batch"), by_label, limit=limit, measured=size["periods"], hot=hot)
    types = types.select("time_period_type", "time_period_code")
    coded = lookup(coded, types, by_type, limit=limit, measured=size["period types"], hot=hot)
    coded = coded.drop("time_period_type", "period_lbl", "month")
    return rename(coded, {"time_period_code": "time_period_type", "period_code": "period_lbl"})


def latest_batch(registry: DataFrame) -> DataFrame:
    """Codes of the periods added last."""
    last = registry.agg(F.max("period_batch").alias("last")).scalar()
    return registry.filter(F.col("period_batch") == last).select("period_code")


def in_latest_batch(df: DataFrame, registry: DataFrame, period: str = "period_lbl") -> DataFrame:
    """Facts of the periods added last."""
    codes = latest_batch(registry).withColumnRenamed("period_code", period).distinct()
    return sized_join(df, codes, [period], "left_semi")
