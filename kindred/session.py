"""A session with the settings that the engine expects, and tables that outlive lost executors."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "12g", name: str = "kindred") -> SparkSession:
    """A local session for tests and benches; on a cluster, pass the session that is there."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on a local master a temporary one where it is unset."""
    context = spark.sparkContext
    given = context.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if given:
        return given.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("spark.checkpoint.dir isn't set: on a cluster, tables need a folder that all executors share")
    if not hasattr(context, "_kindred_folder"):
        context._kindred_folder = tempfile.mkdtemp(prefix="kindred-")
        atexit.register(shutil.rmtree, context._kindred_folder, True)
    return f"file://{context._kindred_folder}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in the store that its path names, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before the interpreter does
        delete(spark, path)


#: While tables are written, a Python worker gets at most so many bytes at once, however long the rows.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """The session with a bound on the bytes of an Arrow batch, as it was afterwards."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` for mapInArrow that gives memory back to the system when it ends: a worker is used again, and would hold beside the next tasks all that this one freed."""

    def trimmed(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return trimmed


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it again: its lineage ends there, and no executor holds it.

    The tables of an application are below one folder, which goes when the driver's interpreter ends;
    `release` deletes a table as soon as nothing reads it any more.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/kindred/{spark.sparkContext.applicationId}"
    if getattr(spark.sparkContext, "_kindred_tables", None) != folder:
        spark.sparkContext._kindred_tables = folder
        atexit.register(_forget, spark, folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._kindred_path = path
    return table


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to as many partitions as shuffles have, for work on each row that few files would leave to few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that may be as large as the input: dealt by its keys, never sent to all executors by way of the driver.

    Spark takes a table for as large as its files. Where few texts are repeated in many rows, these are a small part of what the driver would hold.
    """
    return df.hint("merge")


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more, instead of when the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def release(*tables: DataFrame) -> None:
    """Delete tables that `settle` returned. No frame made from them can be read after this."""
    for table in tables:
        if path := getattr(table, "_kindred_path", None):
            delete(table.sparkSession, path)
