"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder where it is unset, which is for tests on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = getattr(spark, "_corefold_scratch", None)
        if found is None:
            found = spark._corefold_scratch = f"file://{tempfile.mkdtemp(prefix='corefold-')}"
    return found.rstrip("/")


_made: list[str] = []
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Folders that are made within go at the end; what is to stay must be written to a folder made before."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            delete(spark, path)


def clear(spark: SparkSession) -> int:
    """Delete the tables that this process has written, once the results that read them are written elsewhere; how many there were."""
    paths, _made[:] = list(_made), []
    for path in paths:
        delete(spark, path)
    return len(paths)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str) -> DataFrame:
    """Write df as Parquet below the shared folder; return it as read again.

    Once the table is written nothing reads its shuffles again, so their files go at once and not when the driver's memory is next collected.
    """
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
        release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> bool:
    """Hand back what the C library keeps of the memory that the driver's JVM has freed (above all that of its compilers); whether the JVM can."""
    jvm = spark.sparkContext._jvm
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        # The server's own class is not open to calls; its interface is.
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
        args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(server, args)
    except Py4JError:  # another JVM, or not on Linux
        return False
    return True


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Python workers get at most so many rows at a time: whole texts take much room in the JVM's buffers, and again in each worker."""
    if int(spark.conf.get(BATCH_ROWS)) > rows:
        spark.conf.set(BATCH_ROWS, rows)


def folder(spark: SparkSession, label: str) -> str:
    """The path of a new folder that ``clear`` removes."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    if (paths := _passing.get()) is not None:
        paths.append(path)
    return path


def table(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``write`` to a new folder; the table and its path."""
    path = folder(df.sparkSession, label)
    return write(df, path), path
