"""Month files that arrive in a folder, as a stream into the monthly panel.

A delivery is a file in the folder, or a folder of part files in it, which count together, in whatever batches they
arrive.  It stands for one manufacture month, the one most of its rows belong to.  Of several deliveries for one month
the newest counts.  A ledger beside the panel (`_ledger` behind its name) keeps the counts of every delivery by month and
batch; a batch adds to it, and the months it touches are counted anew from it.  A delivery repeated, or a batch
replayed after a failure, therefore leaves the same panel, and a stray row never wipes out another month.  What the panel
does not count is listed in a table (`_dropped` behind its name).  Ledger and stream progress belong together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelwright.functions import columns
from panelwright.operators import panel, ranking
from panelwright.plans.monthly import overwrite_month
from panelwright.schema import RAW_CLAIMS
from panelwright.sources import files
from panelwright.sources.files import delivery


def month_stream(
    spark: SparkSession, folder: str, schema=RAW_CLAIMS, sep: str = ",", encoding: str = "UTF-8", files_per_batch: int | None = None
) -> DataFrame:
    """Claim rows of the CSV files that appear in a folder or its folders, as text columns with delivery (`_file`) and time."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("header", True).option("sep", sep).option("encoding", encoding)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder).select(
        "*", delivery(folder, F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.file_modification_time").alias("_at")
    )


def _dated(rows: DataFrame) -> DataFrame:
    d = F.col("manufacturing_date")
    return files.typed_claims(rows, extra=("_file", "_at")).where(d.isNotNull()).withColumns({"_y": F.year(d), "_m": F.month(d)})


def _entries(dated: DataFrame) -> DataFrame:
    """The ledger's rows of one batch: counts by delivery, series and month; rows without a key only count as rows."""
    by_series = dated.groupBy(F.col("_file").alias("delivery"), *panel.KEYS, F.col("_y").alias("year"), F.col("_m").alias("month"))
    return by_series.agg(F.sum("claim_count").cast("double").alias("claim_count"), F.count(F.lit(1)).alias("rows"), F.max("_at").alias("at"))


def by_delivery(entries: DataFrame) -> DataFrame:
    """Rows by delivery and month, a table the size of the list of deliveries."""
    return entries.groupBy("delivery", "year", "month").agg(F.sum("rows").alias("rows"), F.max("at").alias("at"))


def standing(counts: DataFrame) -> DataFrame:
    """(delivery, year, month): the newest delivery of each month; a delivery is as new as its newest part."""
    month = F.struct("year", "month")
    own = counts.groupBy("delivery").agg(F.max("at").alias("at"), F.max_by(month, F.struct("rows", "year", "month")).alias("t"))
    return own.groupBy("t").agg(F.max_by("delivery", F.struct("at", "delivery")).alias("delivery")).select("delivery", "t.year", "t.month")


def left_out(counts: DataFrame) -> DataFrame:
    """(delivery, year, month, rows, reason) of the rows that the panel does not count: `stray` in a delivery of another
    month, or `superseded` by a newer delivery of the month."""
    month = F.struct("year", "month")
    own = counts.groupBy("delivery").agg(F.max_by(month, F.struct("rows", "year", "month")).alias("t"))
    rest = counts.join(standing(counts), ["delivery", "year", "month"], "left_anti").join(own, "delivery")
    reason = F.when(F.col("t") == month, F.lit("superseded")).otherwise(F.lit("stray"))
    return rest.select("delivery", "year", "month", "rows", reason.alias("reason"))


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def replace_months(panel_path: str):
    """Batch function: enter the batch in the ledger and count the months anew whose deliveries it touches.

    The ledger is partitioned by month and batch, and a batch replaces its own partitions, so a batch replayed changes
    nothing.  Only the affected months are read from it by series.
    """
    ledger = f"{panel_path}_ledger"

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = ranking.checkpointed(_entries(_dated(batch)))
        if fresh.isEmpty():
            return
        partitions = ["year", "month", "batch"]
        writer = fresh.withColumn("batch", F.lit(batch_id)).repartition(*partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(ledger)
        entries = spark.read.parquet(ledger).where(F.col("batch") <= batch_id)
        counts = ranking.checkpointed(by_delivery(entries))
        now, before = standing(counts), standing(by_delivery(entries.where(F.col("batch") < batch_id)))
        touched = now.join(fresh.select("delivery").distinct(), "delivery", "left_semi")
        changed = now.exceptAll(before).unionByName(before.exceptAll(now)).unionByName(touched)
        months = sorted((r["year"], r["month"]) for r in changed.select("year", "month").distinct().collect())  # a row a month
        affected = F.lit(False)
        for year, month in months:
            affected = affected | ((F.col("year") == year) & (F.col("month") == month))
        # one row a month and its delivery
        rows = entries.where(affected).join(F.broadcast(now), ["delivery", "year", "month"], "left_semi").dropna(subset=list(panel.KEYS))
        keys = [*panel.KEYS, "year", "month"]
        counted = rows.groupBy(*keys).agg(F.sum("claim_count").alias("claim_count")).withColumn("series_id", columns.series_id(*panel.KEYS))
        overwrite_month(panel_path, counted.select("series_id", *panel.KEYS, "year", "month", "claim_count"))
        held = {(r["year"], r["month"]) for r in now.where(affected).collect()}  # a row a month
        for year, month in set(months) - held:
            _remove(spark, f"{panel_path}/year={year}/month={month}")
        left_out(counts).coalesce(1).write.mode("overwrite").parquet(f"{panel_path}_dropped")

    return apply


def ingest_months(stream: DataFrame, panel_path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop; run again (or on a schedule) for later files."""
    return (
        stream.writeStream.foreachBatch(replace_months(panel_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
