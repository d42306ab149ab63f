"""Helpers shared by the corpus operators: the shared folder, cut lineage, global row numbers."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which driver and executors share.

    Where it is unset, a local session (tests) gets a folder of its own; any other session is refused,
    since a machine-local folder loses data on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="panelwright-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


#: Lets a write remove its own shuffle files when it is done.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession):
    """Shuffle files of what is written inside go with the write, as nothing reads them again."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends here."""
    spark = df.sparkSession
    path = new_folder(spark)
    with shuffles_end(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_by(df: DataFrame, column: str) -> DataFrame:
    """As `cut`, into as many bucket files by a column as shuffle partitions, so that grouping by it needs no shuffle again.

    The catalogue's entry has a name of its own and outlives the files in a permanent catalogue only.
    """
    spark = df.sparkSession
    path, name = new_folder(spark), f"panelwright_{uuid.uuid4().hex}"
    with shuffles_end(spark):
        df.write.bucketBy(shuffle_partitions(spark), column).format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def gone(*tables: DataFrame) -> None:
    """Delete tables that `cut` has written and nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def given_back() -> None:
    """At the end of a task or batch: return freed memory of the Python worker, which lives on, to the system."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass


def tidy(work):
    """A task's function on batches that gives memory back when it is done and its last batch is let go of."""

    def batches(parts):
        yield from work(parts)
        given_back()

    return batches


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, *order: Column | str, name: str = "row_no") -> tuple[DataFrame, int]:
    """The rows with their 0-based number in a total order, and how many there are.

    Rows are range-partitioned and sorted once; a row's number is its place in its range plus the rows
    of earlier ranges, of which there are as many as shuffle partitions (what is broadcast is that
    small).  The rows are cut, so they should be narrow.
    """
    spark = df.sparkSession
    at = f"_{name}_at"
    ranged = cut(
        df.repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn(at, F.monotonically_increasing_id())
    )
    sizes = ranged.groupBy(F.shiftright(at, 33).alias("_part")).count().collect()  # a row per range
    before, total = {}, 0
    for part, n in sorted(map(tuple, sizes)):
        before[part] = total
        total += n
    offsets = spark.createDataFrame(sorted(before.items()), "_part long, _before long")
    out = (
        ranged.withColumn("_part", F.shiftright(at, 33))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_before", at)
    )
    return out, total


def worker_memo(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    home = sys.modules.setdefault("_panelwright_worker", types.ModuleType("_panelwright_worker"))
    return home.__dict__.setdefault(name, {})
