"""Session defaults and the shared folder that survives lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# The JVM compiles no method above this many bytes; Spark then generates smaller ones instead.
COMPILED_METHOD_BYTES = "8000"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(app_name: str = "casebook") -> SparkSession:
    """A session with the settings results depend on; sizing is left to spark-submit."""
    spark = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(METHOD_LIMIT, COMPILED_METHOD_BYTES)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Keep wide projections compiled in whichever session the caller brought."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, COMPILED_METHOD_BYTES)
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Hand Python tasks started here at most this many rows at a time: a batch is held on both sides."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) <= most:
        spark.conf.set(ARROW_ROWS, str(most))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in this process; ``local-cluster`` has executors of its own."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="casebook-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/casebook/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for one intermediate table."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; results read from them are gone too.

    ``load_csv`` and ``written`` leave tables that their results read; who calls them calls this, or
    works within ``scratch``, when the results are no longer needed.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a table by renaming its folder; what was at ``target`` goes."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    old, new = paths(source), paths(target)
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(new, True)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the application's intermediate tables at the end, also when the work fails."""
    try:
        yield
    finally:
        drop_scratch(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, nothing is recomputed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
