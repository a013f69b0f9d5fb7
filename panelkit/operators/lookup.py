"""Dictionary lookups: strict, soft, inverse, validated, composite and adaptive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.skew import BROADCAST_BYTES, HotKeys, null_safe_join, profile, size, sized_join
from panelkit.session import side_by_side


class RepeatedKeyError(ValueError):
    """A table that must have one row per key has more."""


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> tuple[int, int, int]:
    """Check one row per key (nulls count as equal) and return the table's profile."""
    found = profile(df, keys)
    if found[2] > 1:
        raise RepeatedKeyError(f"{what}: {', '.join(keys)} repeats, up to {found[2]} rows for one key")
    return found


def require_all_unique(dims: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> dict[str, int]:
    """Check several dictionaries in jobs that run side by side, and return their bytes."""
    checks = [lambda d=dim, k=keys, n=name: require_unique(d, k, n)[1] for name, (dim, keys) in dims.items()]
    return dict(zip(dims, side_by_side(*checks)))


def measure_all(dims: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes of several dictionaries, measured in jobs that run side by side."""
    return dict(zip(dims, side_by_side(*[lambda d=d: size(d) for d in dims.values()])))


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    validate: bool = True,
    limit: int = BROADCAST_BYTES,
    measured: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left join of a dictionary; a null key meets a null key.

    ``on`` names the shared key columns, or maps a column of ``df`` to one of ``dim``.
    With ``validate`` a repeated dictionary key is an error, otherwise rows fan out.
    ``measured`` gives the bytes of a dictionary that was checked before. ``hot`` knows the hot keys of the facts
    before a chain of lookups; without it every large lookup runs the joins before it once more to find its own.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    dim = dim.withColumnsRenamed({right: left for left, right in pairs.items() if left != right})
    keys = list(pairs)
    twice = set(df.columns) & set(dim.columns) - set(keys)
    if twice:
        raise ValueError(f"columns on both sides of the lookup: {sorted(twice)}")
    if validate and measured is None:
        measured = require_unique(dim, keys, "dictionary")[1]
    return sized_join(df, dim, keys, limit=limit, measured=measured, hot=hot)


def soft_map(
    df: DataFrame, column: str, dim: DataFrame, key: str, value: str, to: str, **options
) -> DataFrame:
    """``to`` = the dictionary's value for ``column``, null on a miss."""
    pairs = dim.select(F.col(key).alias(column), F.col(value).alias("__value"))
    return lookup(df, pairs, [column], **options).withColumn(to, F.col("__value")).drop("__value")


def strict_map(
    df: DataFrame, column: str, dim: DataFrame, key: str, value: str, to: str, **options
) -> DataFrame:
    """Like ``soft_map``, but a value the dictionary lacks is an error.

    The check sits inside the returned column, so a plan that uses the column cannot lose it.
    """
    pairs = dim.select(
        F.col(key).alias(column), F.col(value).alias("__value"), F.lit(True).alias("__hit")
    )
    joined = lookup(df, pairs, [column], **options)
    wrong = F.raise_error(F.concat(F.lit(f"{column} not in dictionary: "), F.col(column).cast("string")))
    checked = F.when(F.col("__hit").isNotNull() | F.col(column).isNull(), F.col("__value")).otherwise(wrong)
    return joined.withColumn(to, checked).drop("__value", "__hit")


def inverted(dim: DataFrame, code: str, label: str, order: str | None = None) -> DataFrame:
    """One code per label; of repeated labels the last in ``order`` (default: the code) counts."""
    return dim.groupBy(label).agg(F.max_by(code, order or code).alias(code))


def inverse_map(
    df: DataFrame, column: str, dim: DataFrame, code: str, label: str, to: str, order: str | None = None, **options
) -> DataFrame:
    """``to`` = the code whose label is in ``column``, null on a miss.

    ``measured`` may give the bytes of ``dim`` itself, which the inverted table cannot exceed.
    """
    return soft_map(df, column, inverted(dim, code, label, order), label, code, to, validate=False, **options)


def adaptive_lookup(
    df: DataFrame,
    dim: DataFrame,
    column: str,
    keys: Sequence[str],
    shared: Sequence[str] = (),
    validate: bool = False,
    **options,
) -> DataFrame:
    """Look ``column`` up under the first of ``keys``, or under the next one when the
    dictionary does not know some value. Repeated keys fan out unless ``validate``."""
    *tries, chosen = keys
    values = df.select(column).distinct()
    for key in tries:
        known = dim.select(F.col(key).alias(column)).distinct()
        if null_safe_join(values, known, [column], "left_anti").isEmpty():
            chosen = key
            break
    side = dim.drop(*[c for c in dim.columns if c in df.columns and c not in (*shared, chosen)])
    return lookup(df, side, {**{k: k for k in shared}, column: chosen}, validate=validate, **options)


def miss_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a value, one row per recoded column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "variable", "misses")
