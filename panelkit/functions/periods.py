"""Period parts and period labels of both delivery formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.fixed import MONTHS, OLD_PERIOD_HEADS, PERIOD_TYPES
from panelkit.functions.columns import map_value

MONTH_BY_TEXT = {f"{i:02d}": name for i, name in enumerate(MONTHS, 1)}


def month_name(month: Column) -> Column:
    """Abbreviation of a two-digit month text; other text stays as it is."""
    return F.coalesce(map_value(MONTH_BY_TEXT, month), month)


def with_date_parts(df: DataFrame, date: str) -> DataFrame:
    """``year``, ``month`` and ``month_name`` as text, cut from a yyyymmdd value."""
    text = F.col(date).cast("string")
    return df.withColumns(
        {"year": F.substring(text, 1, 4), "month": F.substring(text, 5, 2)}
    ).withColumn("month_name", month_name(F.col("month")))


def numbered_label(head: Column, year: Column, month: Column, name: Column) -> Column:
    """``<head>: yyyy (mm) Mon``."""
    return F.concat(head, F.lit(": "), year, F.lit(" ("), month, F.lit(") "), name)


def with_old_period_label(df: DataFrame, period_type: str) -> DataFrame:
    """Label of an old-format period; an unknown type gives null."""
    head = map_value(OLD_PERIOD_HEADS, F.col(period_type))
    return df.withColumn(
        "period_lbl", numbered_label(head, F.col("year"), F.col("month"), F.col("month_name"))
    )


def with_new_period_labels(df: DataFrame, strict: bool = True) -> DataFrame:
    """Type, display label and sortable label from ``duration``, ``year`` and ``month``.

    The labels of an unknown duration or month fail in strict mode and are null otherwise.
    """
    df = df.withColumns({c: F.col(c).cast("int") for c in ("duration", "year", "month")})
    period_type = map_value(PERIOD_TYPES, F.col("duration"))
    head = F.split_part(period_type, F.lit("/"), F.lit(1))
    month = F.lpad(F.col("month").cast("string"), 2, "0")
    name = map_value(MONTH_BY_TEXT, month)
    year = F.col("year").cast("string")
    display = F.concat(head, F.lit(": "), name, F.lit(" "), year)
    numbered = numbered_label(head, year, month, name)
    if strict:
        wrong = F.raise_error(
            F.concat(
                F.lit("no period label for duration/year/month "),
                F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("duration", "year", "month")]),
            )
        )
        display, numbered = F.coalesce(display, wrong), F.coalesce(numbered, wrong)
    return df.withColumns(
        {"time_period_type": period_type, "period_lbl": display, "label_num": numbered}
    )


def unknown_period_types(df: DataFrame, period_type: str) -> DataFrame:
    """The types that got no label."""
    return df.filter(F.col("period_lbl").isNull()).select(period_type).distinct()
