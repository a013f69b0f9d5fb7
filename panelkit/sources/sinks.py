"""Writers: parquet, category chunks, label sidecar, publishing and staged reuse."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.hierarchy import category_tree

CHUNK_ROWS = 1_000_000


def write_parquet(df: DataFrame, path: str, level: int | None = None, mode: str = "errorifexists") -> None:
    """zstd parquet, at a compression level if one is given."""
    writer = df.write.mode(mode).option("compression", "zstd")
    if level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", level)
    writer.parquet(path)


def write_chunks(
    df: DataFrame, path: str, by: str = "category", rows: int = CHUNK_ROWS, mode: str = "errorifexists"
) -> None:
    """Files of at most ``rows`` rows in one folder per ``by`` value.

    Rebalancing lets the adaptive planner split a large category over many tasks and
    put small ones together, so the number of writers follows the data.
    """
    (
        df.hint("rebalance", by)
        .write.mode(mode)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows)
        .partitionBy(by)
        .parquet(path)
    )


def write_numbered_chunks(
    df: DataFrame, path: str, by: str = "category", chunk: str = "chunk", mode: str = "errorifexists"
) -> None:
    """One folder per category and numbered chunk (see ``with_chunk``)."""
    (
        df.hint("rebalance", by, chunk)
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy(by, chunk)
        .parquet(path)
    )


def write_labels(path: str, values: DataFrame, metrics: DataFrame, mode: str = "errorifexists") -> None:
    """The label sidecar: value labels and variable labels beside the data."""
    write_parquet(values, f"{path}/value_labels", mode=mode)
    write_parquet(metrics, f"{path}/variable_labels", mode=mode)


def write_tree(df: DataFrame, columns: Sequence[str], path: str, mode: str = "errorifexists") -> None:
    """The distinct category tree rows."""
    write_parquet(category_tree(df, columns), path, mode=mode)


def write_report(report: DataFrame, path: str) -> bool:
    """Keep a report for later, an empty one as an empty table; tells whether it has rows."""
    write_parquet(report, path, mode="overwrite")
    return not report.sparkSession.read.schema(report.schema).parquet(path).isEmpty()


def publish(frames: Sequence[DataFrame], path: str, mode: str = "reload") -> None:
    """``reload``: the frames replace the published table; ``append``: all are added. Read it with ``published``.

    Every frame is written to a folder of its own. What is published is the list of folders with the highest version
    number, a single small file that is moved into place last: until then, and for good if a write fails
    before it, readers find the table as it was. Folders of older versions stay, for readers that are still at them.
    One publisher at a time.
    """
    if mode not in ("reload", "append"):
        raise ValueError(f"{mode!r} is no publish mode, use 'reload' or 'append'")
    spark = frames[0].sparkSession
    version, folders = _published_folders(spark, path)
    folders = [] if mode == "reload" else folders
    for df in frames:
        folder = f"part-{uuid.uuid4().hex}"
        write_parquet(df, f"{path}/data/{folder}")
        folders.append(folder)
    listed = spark.createDataFrame([(version + 1, folders)], POINTER)
    write_parquet(listed.coalesce(1), f"{path}/versions", mode="append")


POINTER = "version long, folders array<string>"


def _published_folders(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    try:
        newest = spark.read.schema(POINTER).parquet(f"{path}/versions").agg(F.max_by(F.struct("*"), "version")).first()[0]
    except AnalysisException:
        newest = None
    return (newest.version, list(newest.folders)) if newest else (0, [])


def published(spark: SparkSession, path: str) -> DataFrame:
    """The table that was published last, all its frames under each other; columns some lack are null there."""
    _, folders = _published_folders(spark, path)
    if not folders:
        raise ValueError(f"nothing is published at {path}")
    return spark.read.option("mergeSchema", True).parquet(*[f"{path}/data/{f}" for f in folders])


def write_batch(df: DataFrame, path: str, by: Sequence[str], rows: int | None = None) -> None:
    """Replace exactly the folders (of the ``by`` values, such as batch and category) that ``df`` has rows for."""
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("compression", "zstd")
    if rows:
        writer = writer.option("maxRecordsPerFile", rows)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its success marker."""
    try:
        return not spark.read.format("binaryFile").load(f"{path}/_SUCCESS").limit(0).count()
    except AnalysisException:
        return False


def reuse_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table stored at ``path``; it is built and stored first if it is not there.

    Only a finished write is reused; what a broken one left behind is replaced.
    """
    if not is_complete(spark, path):
        write_parquet(build(), path, mode="overwrite")
    return spark.read.parquet(path)


def write_version(df: DataFrame, path: str, version: int) -> None:
    """A new version of a small table; older ones stay."""
    write_parquet(df.repartition(1), f"{path}/version={version:06d}")


def latest_version(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The newest version of a table and its number."""
    versions = spark.read.parquet(path)
    newest = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == newest).drop("version"), int(newest)
