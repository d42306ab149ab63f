"""Run manifests: a fingerprint of the data and the settings of a run, as table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

#: Types whose text holds neither % nor |.
_PLAIN = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)
#: Bits of a hash summed at a time: three sums of this width stay within a long for 2^41 rows.
_BITS = 22


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and a hash of the content that does not depend on row order, as one row.

    The hash is the sum of the halves of the rows' MD5, modulo 2^64 each: a fingerprint of the multiset of rows, which
    merges by addition, tells repeated rows apart from absent ones, and can be repeated in any SQL.  A row's text joins its
    columns in order of their names by `|`, each as `=` and the value (with % and | as %25 and %7C), or nothing for null.
    """
    plain = {f.name for f in df.schema.fields if isinstance(f.dataType, _PLAIN)}
    escaped = lambda c: F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("|"), F.lit("%7C"))
    text = lambda c: F.col(f"`{c}`").cast("string") if c in plain else escaped(F.col(f"`{c}`").cast("string"))
    h = F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), text(c)), F.lit("")) for c in sorted(df.columns)]))
    half = lambda a: F.conv(F.substring("_h", a, 16), 16, -10).cast("bigint")
    bits = lambda c, k: F.shiftrightunsigned(c, k * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1))
    halves = df.select(h.alias("_h")).select(half(1).alias("_a"), half(17).alias("_b"))
    parts = [F.coalesce(F.sum(bits(c, k)), F.lit(0)).cast("decimal(20,0)").alias(f"{c}{k}") for c in ("_a", "_b") for k in range(3)]
    whole = lambda c: (F.col(f"{c}0") + F.col(f"{c}1") * F.lit(1 << _BITS).cast("decimal(8,0)") + F.col(f"{c}2") * F.lit(1 << 2 * _BITS).cast("decimal(15,0)")).alias(c)
    sums = halves.agg(F.count(F.lit(1)).alias("n_rows"), *parts).select("n_rows", whole("_a"), whole("_b"))
    print_of = lambda c: F.lpad(F.lower(F.conv((F.col(c) % F.lit(str(2**64)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 10, 16)), 16, "0")
    return sums.select("n_rows", F.concat_ws("-", print_of("_a"), print_of("_b")).alias("data_hash"))


def manifest(spark: SparkSession, run_id: str, settings: dict[str, object], data: DataFrame | None = None) -> DataFrame:
    """Key/value rows of one run; with `data`, its fingerprint is added."""
    rows = [(run_id, k, str(v)) for k, v in sorted(settings.items())]
    out = spark.createDataFrame(rows, "run_id string, key string, value string")
    if data is None:
        return out
    f = fingerprint(data)
    print_rows = f.select(
        F.lit(run_id).alias("run_id"),
        F.explode(
            F.map_from_arrays(F.array(F.lit("data_hash"), F.lit("n_rows")), F.array("data_hash", F.col("n_rows").cast("string")))
        ).alias("key", "value"),
    )
    return out.unionByName(print_rows)


def compare_manifests(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys of either run with both values and whether they agree."""
    left = a.select("key", F.col("value").alias("value_a"))
    right = b.select("key", F.col("value").alias("value_b"))
    return left.join(right, "key", "full").withColumn("same", F.col("value_a").eqNullSafe(F.col("value_b")))


def reproducible(comparison: DataFrame) -> DataFrame:
    """Whether data, cross-validation scheme and seed agree, as one row."""
    same = lambda *keys: F.coalesce(F.bool_and(F.when(F.col("key").isin(*keys), F.col("same"))), F.lit(True))
    return comparison.agg(
        same("data_hash").alias("data_match"), same("cv_scheme", "val_window").alias("cv_match"), same("seed").alias("seed_match")
    ).withColumn("reproducible", F.col("data_match") & F.col("cv_match") & F.col("seed_match"))


def append(rows: DataFrame, path: str) -> None:
    rows.withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(path)
