"""Export of finished facts: label checks, chunks, label sidecar, publishing."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import fixed
from panelkit.operators import quality
from panelkit.operators.labels import LabelSource, label_table, metric_labels, present_labels
from panelkit.operators.registry import in_latest_batch
from panelkit.session import stage
from panelkit.sources import sinks

BATCH = "period_batch"
COVERAGE = ["category", "period_lbl", "demo_groups", "shop_code"]


class Checks(NamedTuple):
    unlabelled_columns: list[str]
    uncovered: DataFrame
    coverage: DataFrame
    nulls: DataFrame


def label_sources(
    groups: DataFrame, demo: DataFrame, segments: DataFrame, shops: DataFrame,
    periods: DataFrame, types: DataFrame, years: DataFrame,
) -> list[LabelSource]:
    """Which dictionary labels which coded variable."""
    return [
        LabelSource("category", groups, "category_code", "category name"),
        LabelSource("level_0", groups, "category_code", "category name"),
        LabelSource("features", groups, "feature_code", "feature"),
        LabelSource("cat_segment", segments, "segment_code", "segment"),
        LabelSource("products", groups, "product_code", "full_label"),
        LabelSource("product_hier", groups, "product_code", "product_hier"),
        LabelSource("product_lvls", groups, "product_lvls", "product_lvls"),
        LabelSource("demo_groups", demo, "demo_code", "buyers_gr_label"),
        LabelSource("socdem_gr", demo, "demo_code", "buyers_gr_label"),
        LabelSource("demo_hier", demo, "demo_code", "demo_hier"),
        LabelSource("demo_lvls", demo, "demo_lvls", "demo_lvls"),
        LabelSource("shop_code", shops, "shop_code", "position_name_shop"),
        LabelSource("shop_lvls", shops, "shop_lvls", "shop_lvls"),
        LabelSource("channel_code", shops, "channel_code", "channel_type"),
        LabelSource("year", years, "year_code", "year"),
        LabelSource("time_period_type", types, "time_period_code", "time_period_type"),
        LabelSource("label_num", periods, "period_code", "label_num"),
        LabelSource("period_lbl", periods, "period_code", "period_lbl"),
    ]


def check(df: DataFrame, sources: Sequence[LabelSource]) -> Checks:
    """Columns without labels, codes without labels, coverage and nulls."""
    variables = [s.variable for s in sources]
    labels = stage(label_table(sources), "labels")
    return Checks(
        quality.columns_without_labels(df, [*variables, *fixed.METRIC_LABELS]),
        quality.uncovered_codes(df, labels, variables),
        quality.coverage(df, COVERAGE),
        quality.null_counts(df),
    )


def export(
    df: DataFrame,
    sources: Sequence[LabelSource],
    path: str,
    chunk_rows: int = sinks.CHUNK_ROWS,
    registry: DataFrame | None = None,
    mode: str = "errorifexists",
) -> None:
    """Chunks by category and the label sidecar; with ``registry`` only its latest batch.

    A batch lies in folders of its own, data and labels (``period_batch=n/category=..``). Batches stand side by side, and a run
    replaces its own and no other.
    """
    df = df.drop("file")
    if registry is not None:
        df = in_latest_batch(df, registry)
    values = present_labels(label_table(sources), df)
    variables = metric_labels(df.sparkSession, df, fixed.METRIC_LABELS)
    if registry is None:
        sinks.write_chunks(df, f"{path}/data", rows=chunk_rows, mode=mode)
        sinks.write_labels(path, values, variables, mode=mode)
        return
    number = registry.agg(F.max("period_batch")).first()[0]
    for table, name in ((df, "data"), (values, "value_labels"), (variables, "variable_labels")):
        by = [BATCH, "category"] if name == "data" else [BATCH]
        table = table.withColumn(BATCH, F.lit(number))
        sinks.write_batch(table, f"{path}/{name}", by, chunk_rows if name == "data" else None)
