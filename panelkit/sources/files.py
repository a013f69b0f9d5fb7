"""Readers for flat files, deliveries and dictionaries."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.fixed import FILE_CATEGORIES
from panelkit.functions.columns import lower_headers, nan_to_null
from panelkit.operators.union import union_all

TOTALS_MARK = "_tot.parquet"


def path_parts() -> Column:
    return F.split(F.col("_metadata.file_path"), "/")


def last_parts(n: int = 2) -> Column:
    """The last ``n`` parts of the path a row was read from."""
    parts = path_parts()
    return F.array_join(F.slice(parts, -n, n), "/")


def file_stem() -> Column:
    """Name of the file a row was read from, up to its first dot."""
    return F.split_part(F.element_at(path_parts(), -1), F.lit("."), F.lit(1))


def flat_csv(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """CSV with a header line, plain or gzip; the schema is given, never inferred."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return nan_to_null(reader.csv(path))


def stacked(spark: SparkSession, paths: Sequence[str], provenance: str | None = "file") -> DataFrame:
    """The named parquet files under each other; columns some files lack are null there."""
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    if provenance:
        df = df.select("*", file_stem().alias(provenance))
    return nan_to_null(df)


def deliveries(
    spark: SparkSession,
    folders: str | Sequence[str],
    pattern: str = "*.parquet",
    schema: StructType | str | None = None,
    skip: str | None = TOTALS_MARK,
    provenance: str = "file",
) -> DataFrame:
    """Every file below the folders that fits the pattern, except the totals-only ones.

    The provenance column holds the last two parts of the path. Without a schema the
    files' own schemas are merged, which reads all their footers.
    """
    folders = [folders] if isinstance(folders, str) else list(folders)
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    df = reader.parquet(*folders)
    if skip:
        df = df.filter(~F.col("_metadata.file_path").contains(skip))
    return nan_to_null(df.select("*", last_parts().alias(provenance)))


def category_of(name: Column, strict: bool = True) -> Column:
    """Category of a file name: the first known piece it contains decides."""
    (piece, category), *rest = FILE_CATEGORIES
    found = F.when(name.contains(piece), category)
    for piece, category in rest:
        found = found.when(name.contains(piece), category)
    if not strict:
        return found
    return found.otherwise(F.raise_error(F.concat(F.lit("no category in file name: "), name)))


def category_of_first_token(name: Column) -> Column:
    """Older rule: the text before the first ``_`` must be a known piece."""
    token = F.split_part(name, F.lit("_"), F.lit(1))
    found = F.lit(None).cast("string")
    for piece, category in reversed(FILE_CATEGORIES):
        found = F.when(token == piece, category).otherwise(found)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no category in file name: "), name)))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dictionary(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A dictionary table (parquet, or CSV if the file name ends so) with lower-case headers."""
    if re.search(r"\.csv(\.\w+)?/?$", path):
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
        return lower_headers(reader.csv(path))
    return lower_headers(spark.read.parquet(path))


def wanted_columns(example: DataFrame, extra: Sequence[str] = ("shop_code", "shop_lvls", "channel_code", "file")) -> list[str]:
    """The output columns: the header of the example table and the columns always kept."""
    return list(dict.fromkeys([*(c.lower() for c in example.columns), *extra]))


def metric_renames(legends: DataFrame, mask: str = "mask", column: str = "colum") -> dict[str, str]:
    """Delivered metric name -> output name; the table has one row per metric."""
    rows = legends.filter(F.col(mask).isNotNull()).select(mask, column).collect()
    return {row[0]: row[1] for row in rows}


def stack_deliveries(frames: Sequence[DataFrame]) -> DataFrame:
    """Deliveries with different columns under each other."""
    return union_all(frames, fill=True)
