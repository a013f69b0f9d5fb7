"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DecimalType, MapType, StringType, StructType

_local_roots: dict[str, str] = {}
# Folders staged in the innermost open scope.
_staged: ContextVar[list[str]] = ContextVar("staged", default=[])


# Bytes a shuffle partition is to hold: tens of thousands of partitions at 100 TB; it may spill.
SHUFFLE_BYTES = 2 * 1024**3


def session(
    app: str = "panelkit", master: str | None = None, input_bytes: int = 0, **conf
) -> SparkSession:
    """A session with the settings this package is written for.

    ``input_bytes``, the size of the facts to come, sets how finely shuffles are cut at
    first; the adaptive planner then joins small pieces. Scans are cut more coarsely for large facts.
    """
    pieces = max(200, input_bytes // SHUFFLE_BYTES)
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(pieces))
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.files.maxPartitionBytes", str(min(1024**3, max(128 * 1024**2, input_bytes // 100_000))))
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session may go without it and gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="panelkit-")
    return _local_roots[app]


def staging_path(spark: SparkSession, name: str) -> str:
    """A folder nobody else writes to."""
    return f"{staging_root(spark)}/panelkit/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of any executor, and later readers prune
    columns and push filters into the written table.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    _staged.get().append(path)
    return table


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables whose successors are written; frames that are no staged tables are left alone.

    Plans that still read such a table fail, so it is for tables that nothing unwritten depends on.
    """
    for table in tables:
        path = getattr(table, "staged_path", None)
        if path:
            _delete(table.sparkSession, path)
            table.staged_path = None


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end every table staged inside but those handed to the function it gives.

    ``with staging_scope(spark) as keep: result = keep(stage(plan, "result"))`` leaves the result alone in the
    folder. Steps that ``side_by_side`` runs belong to the scope that is open around them.
    """
    mine: list[str] = []
    kept: set[str] = set()

    def keep(table: DataFrame) -> DataFrame:
        kept.add(table.staged_path)
        return table

    token = _staged.set(mine)
    try:
        yield keep
    finally:
        _staged.reset(token)
        _staged.get().extend(p for p in mine if p in kept)
        for path in mine:
            if path not in kept:
                _delete(spark, path)


def row_bytes(df: DataFrame) -> Column:
    """Rough in-memory size of a row."""
    size = F.lit(16)
    for field in df.schema:
        size = size + _value_bytes(F.col(f"`{field.name}`"), field.dataType)
    return size.cast("long")


def _value_bytes(column: Column, kind: DataType) -> Column:
    """Rough size of one value; nested values count with all they hold."""
    if isinstance(kind, (StringType, BinaryType)):
        return 8 + F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, ArrayType):
        inner = F.aggregate(column, F.lit(0).cast("long"), lambda n, x: n + _value_bytes(x, kind.elementType))
        return 16 + F.coalesce(inner, F.lit(0))
    if isinstance(kind, MapType):
        keys, values = ArrayType(kind.keyType), ArrayType(kind.valueType)
        return _value_bytes(F.map_keys(column), keys) + _value_bytes(F.map_values(column), values)
    if isinstance(kind, StructType):
        size = F.lit(16)
        for field in kind:
            size = size + _value_bytes(column.getField(field.name), field.dataType)
        return size
    return F.lit(16 if isinstance(kind, DecimalType) and kind.precision > 18 else 8)


def stage_sized(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """``stage``, and the rows and bytes of the table, counted by the write itself."""
    seen = Observation(name)
    counted = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")
    )
    staged = stage(counted, name)
    return staged, seen.get["rows"], seen.get["bytes"]


def side_by_side(*steps: Callable) -> list:
    """Results of independent steps, whose Spark jobs share the cluster instead of queueing."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [result.result() for result in [pool.submit(copy_context().run, step) for step in steps]]
