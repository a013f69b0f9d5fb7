"""Shares of the demographic total."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.fixed import TOTAL_DEMO
from panelkit.functions.columns import share
from panelkit.operators.skew import BROADCAST_BYTES, sized_join
from panelkit.session import stage_sized

SHARES = {"value_share": "spend_local_currency", "buyers_share": "buying_households"}


def totals(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], demo: str, total: int = TOTAL_DEMO
) -> DataFrame:
    """The metrics of the total group, one row per key.

    Equal total rows count once. Unequal ones are an error, raised inside the returned
    columns so that no plan using them can lose the check.
    """
    plain = {f"__{side}_{m}": getattr(F, side)(m) for m in metrics for side in ("min", "max", "count")}
    per_key = (
        df.filter(F.col(demo) == total)
        .groupBy(*keys)
        .agg(F.count("*").alias("__rows"), *[c.alias(n) for n, c in plain.items()])
    )
    unequal = F.lit(False)
    for m in metrics:
        some_null = (F.col(f"__count_{m}") > 0) & (F.col(f"__count_{m}") < F.col("__rows"))
        differ = F.coalesce(F.col(f"__min_{m}") != F.col(f"__max_{m}"), F.lit(False))
        unequal = unequal | some_null | differ
    wrong = F.raise_error(
        F.concat(F.lit("more than one total for "), F.to_json(F.struct(*keys)))
    ).cast("double")
    checked = [F.when(unequal, wrong).otherwise(F.col(f"__max_{m}")).alias(f"total_{m}") for m in metrics]
    return per_key.select(*keys, *checked)


def with_shares(
    df: DataFrame,
    keys: Sequence[str],
    shares: Mapping[str, str] = SHARES,
    demo: str = "demo_groups",
    total: int = TOTAL_DEMO,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each metric in per cent of the total row with the same ``keys``, null keys being equal.

    The totals are few beside the facts and are written first. Small enough they are
    broadcast and the facts are not shuffled at all, else both meet by key with hot keys
    cut up. Reads ``df`` more than once, so hand in a written table, not a long plan.
    """
    metrics = list(dict.fromkeys(shares.values()))
    side, _, measured = stage_sized(totals(df, keys, metrics, demo, total), "totals")
    joined = sized_join(df, side, keys, limit=limit, measured=measured)
    return joined.withColumns(
        {name: share(F.col(m), F.col(f"total_{m}")) for name, m in shares.items()}
    ).drop(*[f"total_{m}" for m in metrics])
