"""Small helpers on DataFrames: tables of a folder, written cuts of the lineage, ranks without hot groups."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANK_BUCKETS = 1024  # parts of one rank group; each is sorted by itself


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, once an application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="lastword-code-"), "lastword.zip")
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Whole texts travel to Python: few rows a batch keep a worker's memory bounded."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def trim() -> None:
    """Gives memory that this worker no longer uses back to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def lean(run: Callable) -> Callable:
    """A function for mapInArrow whose task leaves no unused memory in its worker: workers outlive their tasks, and
    those of an executor add up."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return task


def lean_group(run: Callable) -> Callable:
    """The same of a function of one group's table for applyInArrow."""
    def task(table):
        try:
            return run(table)
        finally:
            trim()

    return task


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; one of our own only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    if not root:
        set_by_hand = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = set_by_hand.get() if set_by_hand.isDefined() else None
    if not root:
        root = tempfile.mkdtemp(prefix="lastword-checkpoints-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: survives lost executors and ends its lineage."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    del df
    release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now: it does so for plans that neither
    Python nor the driver's JVM holds any more, and else only when it happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim_driver(spark)


def trim_driver(spark: SparkSession) -> None:
    """Gives memory outside the heap that the driver's JVM has freed back to the system: planning and compiling
    many steps takes it in many threads, and what each thread's share keeps adds up.

    It is the command System.trim_native_heap of the JVM. Its bean's class is closed to py4j, the interface is not.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods()
                      if m.getName() == "invoke")
        call = gateway.new_array(jvm.Object, 4)
        call[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        call[1] = "systemTrimNativeHeap"
        invoke.invoke(server, call)
    except Py4JError:  # a JVM without this command, or not the GNU C library
        pass


def ranked_counts(counts: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds first: the number of rows of the same group that stand before this row.

    counts holds distinct rows with a column n, how often each occurs. A group is cut into
    RANK_BUCKETS parts by the hash of the order columns, each part is summed by itself, and only
    the parts' totals, at most RANK_BUCKETS a group, meet in one window.
    """
    part = counts.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(RANK_BUCKETS)))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (part.groupBy(*group, "_part").agg(F.sum("n").alias("_total"))
              .withColumn("_base", F.coalesce(F.sum("_total").over(before), F.lit(0)))
              .drop("_total"))
    inside = (Window.partitionBy(*group, "_part").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (part.withColumn("_in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(totals, [*group, "_part"])
            .withColumn("first", F.col("_base") + F.col("_in")).drop("_part", "_base", "_in"))


def other_columns_aside(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage over documents that never sees what the caller's further columns are called.

    They go through under names that no operator uses and come back under their own, so a name that a
    stage uses itself, or one that differs from `text` by case alone, neither clashes nor is overwritten.
    """
    own = ("doc_id", "text", "lang", "source", "n_chars")

    @functools.wraps(stage)
    def run(docs: DataFrame, *rest, **named) -> DataFrame:
        names = docs.columns
        known = [name in own or (name.lower() in own and name.lower() not in names) for name in names]
        held = [name if mine else f"caller column {k}" for k, (name, mine) in enumerate(zip(names, known))]
        out = stage(docs.toDF(*held), *rest, **named)
        back = dict(zip(held, names))
        return out.toDF(*[back.get(name, name) for name in out.columns])

    return run


def numbered(first: Column, n: Column, step: int = 1 << 16) -> tuple[Column, Column]:
    """Two generators that unfold a row into first .. first + n - 1 without one long array."""
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(step))))
    return blocks, F.explode(F.sequence(
        first + F.col("_block") * step, first + F.least(n, (F.col("_block") + 1) * step) - 1))
