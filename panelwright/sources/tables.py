"""Claim rows derived from the star-schema tables.

A claim is a line item: where it was supplied from, what was sold, how it came back, when it was
shipped (occurrence) and when it was ordered (manufacture).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAINS = {
    "dense": ("r_name", "p_type", "l_returnflag"),
    "sparse": ("n_name", "p_brand", "l_returnflag"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims(
    spark: SparkSession,
    sf_dir: str,
    grain: str = "dense",
    made: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per line item with its three keys, two dates and a count.

    `grain="sparse"` has many small series of single claims.  `made` bounds the manufacture date and
    reaches the scan of `orders` as a pushed filter.  Join strategies are left to the optimizer: it
    broadcasts a dimension only when its measured size is below the session's threshold.
    """
    plant, product, category = GRAINS[grain]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    if made is not None:
        lo, hi = (F.lit(d).cast("timestamp_ntz") for d in made)
        orders = orders.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi + F.expr("interval 1 day")))
    part = table(spark, sf_dir, "part").select("p_partkey", product)
    nation = table(spark, sf_dir, "nation")
    if grain == "dense":
        region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
        nation = nation.join(region, nation.n_regionkey == region.r_regionkey)
    places = (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_nationkey")
        .join(nation.select("n_nationkey", plant), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", plant)
    )
    count = F.col("l_quantity").cast("int") if grain == "dense" else F.lit(1)
    # orders come first: their date filter shrinks the rows before the other joins
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col(plant).alias("plant"),
            F.col(product).alias("product_cat2"),
            F.col(category).alias("mid_category"),
            F.col("l_shipdate").cast("date").alias("occurrence_date"),
            F.col("o_orderdate").cast("date").alias("manufacturing_date"),
            count.alias("claim_count"),
        )
    )


def as_event_claims(events: DataFrame, *extra: Column) -> DataFrame:
    """Events (batch or stream) as claim rows: user group, type, size and day of each event."""
    return events.select(
        F.concat(F.lit("G"), F.pmod(F.col("user_id"), F.lit(10))).alias("plant"),
        F.col("event_type").alias("product_cat2"),
        F.when(F.col("value") >= 50, "high").otherwise("low").alias("mid_category"),
        F.col("ts").cast("date").alias("occurrence_date"),
        F.col("ts").cast("date").alias("manufacturing_date"),
        F.lit(1).alias("claim_count"),
        *extra,
    )


def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_claims(table(spark, sf_dir, "events"))
