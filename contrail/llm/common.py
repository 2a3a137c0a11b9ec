"""What the operators share: the cluster's scratch folder, written tables and narrow column selection."""

from __future__ import annotations

import ctypes
import gc
import posixpath
import re
import sys
import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share.

    A local folder is made only where that setting is missing and everything runs in one process, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="contrail-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in this application's own part of it."""
    return posixpath.join(shared_dir(spark), f"contrail-{spark.sparkContext.applicationId}", f"{name}-{uuid.uuid4().hex}")


#: Most bytes of one Arrow batch for a Python worker; by rows alone a batch of long texts has no bound.
BATCH_BYTES = 8 << 20


def bounded(df: DataFrame) -> DataFrame:
    """df, whose session from now on sends Python workers batches of at most BATCH_BYTES, or one row."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


#: What worker processes keep for tasks to come, by module: encoders and automata.
KEPT = {"contrail.llm.tokens": "_ENCODERS", "contrail.llm.decontamination": "_MATCHERS"}


def lean(*keep: str) -> None:
    """At the start of a worker's task: give back what tasks of other operators have left in its process, but for modules named in keep.

    Spark uses one process for all tasks, so a vocabulary of some 80 MB would stay beside whatever comes later.
    """
    held = [found for name, kept in KEPT.items() if name not in keep and (found := getattr(sys.modules.get(name), kept, None))]
    if not held:
        return
    for found in held:
        found.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; others have none
    if trim is not None:
        trim(0)


def eased(spark: SparkSession) -> str | None:
    """Give back to the system what the driver's JVM has freed outside its heap, and what it says to that; None for a JVM that can't.

    Each statement's code is compiled on the driver too. What its compilers free stays with the C library, scattered over its arenas: some 250 MB after
    the statements of the near-duplicate stage.
    """
    jvm = spark._jvm
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)  # name, operation, no arguments
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        return call.invoke(server, given)
    except Py4JError:
        return None


#: Spark's own switch for dropping a statement's shuffle files when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: later reads don't depend on executors that are gone. Its shuffle files go when it is written."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    eased(spark)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame | None) -> None:
    """Delete the files of written tables that nothing reads any more."""
    for df in tables:
        for file in df.inputFiles()[:1] if df is not None else ():
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if f"contrail-{df.sparkSession.sparkContext.applicationId}" in folder.toString():
                folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folded(df: DataFrame, *leave: str) -> Column:
    """All columns of df but those in leave as one struct, so that joins beside it can't clash with their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in leave])


def chunks(rows, size: int):
    """Lists of at most size rows."""
    part: list = []
    for row in rows:
        part.append(row)
        if len(part) >= size:
            yield part
            part = []
    if part:
        yield part
