"""File sources and sinks: CSV, parquet, nested JSON documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import calendar
from panelwright.schema import ALIASES, MODEL_DOCUMENT, SERIES_DOCUMENT, normalise_columns

REQUIRED = ("plant", "product_cat2", "mid_category", "manufacturing_date", "claim_count")


def read_claim_csv(
    spark: SparkSession,
    paths: str | list[str],
    pattern: str | None = None,
    encoding: str = "UTF-8",
    sep: str = ",",
) -> DataFrame:
    """Claim rows as text columns from CSV files with headers, one header layout per call.

    `pattern` is a glob on file names.  Headers are matched by alias, so files of different layouts
    are read by separate calls and put together with `union_years`.
    """
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return normalise_columns(reader.csv(paths), ALIASES)


def union_years(frames: list[DataFrame]) -> DataFrame:
    """All rows of several frames; columns absent from one become null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def year_paths(source_dir: str, years: list[int], template: str = "{year}_raw.csv") -> list[str]:
    return [f"{source_dir.rstrip('/')}/{template.format(year=y)}" for y in years]


def typed_claims(raw: DataFrame, required: tuple[str, ...] = REQUIRED, extra: tuple[str, ...] = ()) -> DataFrame:
    """Trim texts, read dates in both accepted forms and counts with separators.

    Columns named in `extra` are carried along as they are.

    Rows whose date cannot be read keep a null date; `bad_dates` counts them.
    """
    df = normalise_columns(raw, ALIASES | {c: (c,) for c in extra}, required)
    casts = []
    for name in df.columns:
        if name in extra:
            casts.append(F.col(name))
        elif name.endswith("_date"):
            casts.append(calendar.parse_date(F.col(name)).alias(name))
        elif name == "claim_count":
            casts.append(calendar.parse_count(F.col(name)).alias(name))
        elif name == "sample_weight":
            casts.append(F.col(name).cast("double").alias(name))
        else:
            casts.append(F.trim(F.col(name)).alias(name))
    return df.select(*casts)


def bad_dates(raw: DataFrame, date_col: str = "manufacturing_date", examples: int = 3) -> DataFrame:
    """Number of unreadable dates and a few of them, as one row."""
    df = normalise_columns(raw, ALIASES, (date_col,))
    bad = df.where(calendar.parse_date(F.col(date_col)).isNull()).select(F.col(date_col).alias("bad"))
    few = bad.orderBy("bad").limit(examples).agg(F.sort_array(F.collect_list("bad")).alias("examples"))
    return bad.agg(F.count(F.lit(1)).alias("n_bad")).select("n_bad", few.scalar().alias("examples"))


def read_claims_strict(spark: SparkSession, paths, **options) -> DataFrame:
    """As `read_claim_csv` + `typed_claims`, but reading a row with an unreadable date fails."""
    raw = read_claim_csv(spark, paths, **options)
    typed = typed_claims(raw)
    checked = F.when(
        F.col("manufacturing_date").isNull(),
        F.raise_error(F.lit("unreadable manufacturing_date")).cast("date"),
    ).otherwise(F.col("manufacturing_date"))
    return typed.withColumn("manufacturing_date", checked)


def read_panel(spark: SparkSession, path: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Parquet panel; the year range prunes partitions or row groups."""
    df = spark.read.parquet(path)
    return df if years is None else df.where(F.col("year").between(*years))


def write_panel(panel: DataFrame, path: str, by: tuple[str, ...] = ("year", "month")) -> None:
    """Parquet partitioned by slot, sorted by series inside each file.

    The rows are first hashed on the partition columns plus the series, so that a month is written
    by many tasks at scale and AQE can merge the small ones.
    """
    (
        panel.repartition(*by, F.pmod(F.xxhash64("series_id"), F.lit(64)))
        .sortWithinPartitions(*by, "series_id")
        .write.mode("overwrite")
        .partitionBy(*by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERIES_DOCUMENT).json(path)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """Nested model documents; `documents.flat_models` makes them a table."""
    return spark.read.schema(MODEL_DOCUMENT).json(path)


def delivery(folder: str, path: Column) -> Column:
    """The file or folder directly in `folder` that a file belongs to; the file itself if it lies elsewhere."""
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*(?=/)", "", folder).rstrip("/")
    found = F.regexp_extract(path, rf"^(.*\Q{root}\E/+[^/]+)", 1)
    return F.when(found != "", found).otherwise(path)


def latest_month(df: DataFrame) -> DataFrame:
    """Rows from the file whose name carries the greatest year and month (`2024_01`, `202401`, ...).

    Only the path column is read to find the month; the filter on it then skips nothing but rows,
    so on a partitioned table filter on the partition columns instead.
    """
    found = F.regexp_extract(F.input_file_name(), r"(\d{4})[_.-]?(\d{2})[^/]*$", 0)
    digits = F.regexp_replace(F.regexp_extract(found, r"^(\d{4}[_.-]?\d{2})", 1), r"\D", "")
    stamped = df.withColumn("_stamp", F.coalesce(digits.try_cast("int"), F.lit(0)))
    newest = stamped.agg(F.max("_stamp").alias("m")).scalar()
    return stamped.where(F.col("_stamp") == newest).drop("_stamp")

