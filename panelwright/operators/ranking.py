"""Total orders over whole tables without one task seeing all rows.

A plain window without a partition sends every row to one task.  Here the rows are range-partitioned by
the order keys, sorted and written once; the sums of the partitions (one row each) give each its offset, and a
row's place or running sum is that within its partition plus the offset.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shared_folder(session: SparkSession) -> str:
    """The checkpoint folder the session names (`spark.checkpoint.dir`); only a local session without
    one, as in tests, gets a temporary folder.  On a cluster such a folder would lose data, so a
    session there must name a shared one."""
    context = session.sparkContext
    if context.getCheckpointDir() is None:
        named = session.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="panelwright-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write df once to the shared checkpoint folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def with_ranges(df: DataFrame, order: list[Column], tie: str, ranges: int | None = None) -> DataFrame:
    """The rows range-partitioned and sorted, written once, with `_key` (struct that sorts the rows ascending), `_range`
    (number of the partition, monotone in the key) and `_place` (0, 1, ... within it).

    `tie` must make keys unique, so that no single key can fill a range.  There are as many ranges as shuffle
    partitions, if nothing else is asked for.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.col(tie).alias("tie")))
    placed = keyed.repartitionByRange(ranges, "_key").sortWithinPartitions("_key").withColumn("_id", F.monotonically_increasing_id())
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return checkpointed(placed).select("*", F.shiftright("_id", 33).alias("_range"), place.alias("_place")).drop("_id")


def _offsets(ranged: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """(_range, one column for each sum): the sums over all earlier ranges; a row per range, so the window is small."""
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    per_range = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_o_{name}") for name, c in sums.items()])
    return per_range.select("_range", *[F.coalesce(F.sum(f"_o_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums])


def running_totals(df: DataFrame, order: list[Column], tie: str, totals: dict[str, Column]) -> DataFrame:
    """Add, for each (name, column) of `totals`, its running sum in the given total order."""
    ranged = with_ranges(df.select("*", *[x.alias(f"_x_{c}") for c, x in totals.items()]), order, tie)
    offsets = _offsets(ranged, {c: F.col(f"_x_{c}") for c in totals})
    inside = W.partitionBy("_range").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    return ranged.join(F.broadcast(offsets), "_range").select(
        *df.columns, *[(F.col(f"_o_{c}") + F.sum(f"_x_{c}").over(inside)).alias(c) for c in totals]
    )


def ranked(df: DataFrame, order: list[Column], tie: str = "series_id", out: str = "rank") -> DataFrame:
    """Add the row number 1..n in the given order (ascending expressions; negate for descending)."""
    ranged = with_ranges(df, order, tie)
    numbered = ranged.join(F.broadcast(_offsets(ranged, {out: F.lit(1)})), "_range")
    return numbered.select(*df.columns, (F.col(f"_o_{out}") + F.col("_place") + 1).cast("long").alias(out))


def quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Exact interpolated quantiles over all rows, as one row: {output name: (column, probability)}.

    An exact percentile aggregate holds every distinct value in one task.  Here equal values of each column are
    counted first, and one running sum of the counts serves all columns; the two values around each wanted
    position are then plain minima.  A column without values has null quantiles.
    """
    columns = sorted({c for c, _ in wanted.values()})
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns]))
    counts = df.select(pair.alias("p")).select("p.*").where("v IS NOT NULL").groupBy("c", "v").agg(F.count(F.lit(1)).alias("k"))
    ranged = with_ranges(counts, [F.col("c")], "v")
    inside = W.partitionBy("_range").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    seen = ranged.join(F.broadcast(_offsets(ranged, {"k": F.col("k")})), "_range").select(
        "c", "v", (F.col("_o_k") + F.sum("k").over(inside)).alias("seen")
    )
    # a row per column: its rows and those of the columns before it
    sizes = ranged.groupBy("c").agg(F.sum("k").alias("n"))
    sizes = sizes.select("c", "n", F.coalesce(F.sum("n").over(W.orderBy("c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    asked = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(c).alias("c"), F.lit(float(p)).alias("p")) for name, (c, p) in wanted.items()])
    places = sizes.select("*", F.explode(F.filter(asked, lambda x: x["c"] == F.col("c"))).alias("w"))
    places = places.select("c", "base", F.col("w.name").alias("name"), ((F.col("n") - 1) * F.col("w.p")).alias("at"))
    later = [F.min(F.when(F.col("seen") - F.col("base") > f("at"), F.col("v"))) for f in (F.floor, F.ceil)]
    found = seen.join(F.broadcast(places), "c").groupBy("name", "at").agg(later[0].alias("a"), later[1].alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))
    return found.agg(*[F.max(F.when(F.col("name") == name, value)).alias(name) for name in wanted])


def top(df: DataFrame, k: int, order: list[Column], out: str | None = None) -> DataFrame:
    """The first k rows, each task keeping k; with `out`, numbered (k rows meet in one task)."""
    best = df.orderBy(*order).limit(k)
    if out is None:
        return best
    return best.withColumn(out, F.row_number().over(W.orderBy(*order)).cast("long"))
