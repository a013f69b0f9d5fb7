"""Filters, projections, renames and metric arithmetic, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def literal_map(values: Mapping) -> Column:
    """A constant map column."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def map_value(values: Mapping, key: Column) -> Column:
    """The value under ``key``, null when there is none."""
    return F.try_element_at(literal_map(values), key)


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows with a value above zero; null is dropped."""
    return df.filter(F.col(column) > 0)


def drop_ids(df: DataFrame, column: str, ids: Iterable, where: Column | None = None) -> DataFrame:
    """Rows whose id is not listed, a null id counting as listed. ``where`` limits the rule to some rows."""
    kept = ~F.col(column).isin(list(ids))
    if where is not None:
        kept = kept | ~F.coalesce(where, F.lit(False))
    return df.filter(kept)


def reparent(
    df: DataFrame, child: str, parent: str, moves: Mapping[int, int], where: Column | None = None
) -> DataFrame:
    """Give the listed nodes another parent. ``where`` limits the rule to some rows."""
    moved = map_value(moves, F.col(child)).cast(df.schema[parent].dataType)
    if where is not None:
        moved = F.when(where, moved)
    return df.withColumn(parent, F.coalesce(moved, F.col(parent)))


def lower_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def snake_headers(df: DataFrame, plus: bool = False) -> DataFrame:
    """Lower-case headers with ``_`` for a blank, and for ``+`` if asked."""
    names = [c.lower().replace(" ", "_") for c in df.columns]
    return df.toDF(*[c.replace("+", "_") if plus else c for c in names])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def keep_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([c for c in dict.fromkeys(wanted) if c in df.columns])


def drop_matching(df: DataFrame, *prefixes: str) -> DataFrame:
    """Without the numbered columns ``<prefix>0, <prefix>1, ...`` and their ``_code`` twins."""

    def numbered(name: str) -> bool:
        stem = name.removesuffix("_code")
        return any(stem.startswith(p) and stem[len(p):].isdigit() for p in prefixes)

    return df.drop(*[c for c in df.columns if numbered(c)])


def recode(df: DataFrame, column: str, values: Mapping[str, str], where: Column | None = None) -> DataFrame:
    """Replace listed spellings, leaving every other value. ``where`` limits the rule to some rows."""
    new = map_value(values, F.col(column))
    if where is not None:
        new = F.when(where, new)
    return df.withColumn(column, F.coalesce(new, F.col(column)))


def default_by(df: DataFrame, column: str, by: str, defaults: Mapping[str, str]) -> DataFrame:
    """Fill ``column`` (added if the files lack it) with the default of the row's ``by`` value."""
    if column not in df.columns:
        df = df.withColumn(column, F.lit(None).cast("string"))
    return df.withColumn(column, F.coalesce(F.col(column), map_value(defaults, F.col(by))))


def fold_case(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lower(F.col(column)))


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def copy_codes(df: DataFrame, copies: Mapping[str, str]) -> DataFrame:
    """New columns equal to existing ones, given as new -> existing."""
    return df.withColumns({new: F.col(old) for new, old in copies.items()})


def to_thousands(df: DataFrame, metrics: Iterable[str]) -> DataFrame:
    return df.withColumns({m: F.col(m) / 1000 for m in metrics})


def blank(df: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """Set metrics to missing."""
    return df.withColumns({m: F.lit(None).cast("double") for m in metrics})


def rounded(column: Column, digits: int = 3) -> Column:
    """Round the scaled value half to even, as numpy does (``round`` goes half up)."""
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def round_metrics(df: DataFrame, metrics: Iterable[str], digits: int = 3) -> DataFrame:
    return df.withColumns({m: rounded(F.col(m), digits) for m in metrics})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def metric_columns(df: DataFrame) -> list[str]:
    """Metrics are the floating-point columns; every other column is a key."""
    return [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]


def key_columns(df: DataFrame) -> list[str]:
    metrics = set(metric_columns(df))
    return [c for c in df.columns if c not in metrics]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing metrics are null, never NaN."""
    return df.withColumns(
        {m: F.when(~F.isnan(F.col(m)), F.col(m)) for m in metric_columns(df)}
    )


def share(metric: Column, total: Column) -> Column:
    """Per cent of a total; null where the total is zero or unknown."""
    return F.try_divide(metric, total) * 100
