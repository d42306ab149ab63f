"""Queries that take the claims through files: layouts, documents, month folders, increments."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelwright.catalog.base import END, START, month_panel, query
from panelwright.operators import documents, panel, ranking
from panelwright.plans import curate, increment
from panelwright.sources import arrivals, files, tables

#: First manufacture year of the second layout.
CHANGE = 1998
#: The month that is delivered twice, first without the claims that came more than this many days after manufacture.
TWICE, LATE_DAYS = (2001, 5), 30


def scratch(spark) -> str:
    """A new folder in the shared one."""
    return f"{ranking.shared_folder(spark)}/filed-{uuid.uuid4().hex}"


def two_layouts(spark, sf_dir, damaged: bool) -> list[arrivals.Layout]:
    """The dense claims as files of two layouts: Latin headers, semicolons and ISO dates, later Korean headers, commas
    and compact dates.  `damaged` spoils some rows of the second: dates of the 29th are written day first, counts of
    claims that occurred on a 31st are no numbers, and the plant of claims made on a 13th is blank."""
    rows = tables.claims(spark, sf_dir)
    made, seen = F.col("manufacturing_date"), F.col("occurrence_date")
    where = scratch(spark)
    old = rows.where(F.year(made) < CHANGE).select(
        seen.alias("claim_date"), made.alias("production_date"), "plant", "product_cat2", "mid_category", F.col("claim_count").alias("count")
    )
    spoilt = F.lit(damaged)
    new = rows.where(F.year(made) >= CHANGE).select(
        F.when(spoilt & (F.dayofmonth(seen) == 31), "n/a").otherwise(F.format_number("claim_count", 0)).alias("클레임건수"),
        F.when(spoilt & (F.dayofmonth(made) == 13), " ").otherwise(F.col("plant")).alias("플랜트"),
        F.col("product_cat2").alias("제품범주2"),
        F.col("mid_category").alias("중분류"),
        F.when(spoilt & (F.dayofmonth(made) == 29), F.date_format(made, "dd/MM/yyyy")).otherwise(F.date_format(made, "yyyyMMdd")).alias("제조일자"),
        F.date_format(seen, "yyyyMMdd").alias("접수일"),
    )
    old.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(f"{where}/old")
    new.write.option("header", True).csv(f"{where}/new")
    return [arrivals.Layout(f"{where}/old", ";", "ISO-8859-1"), arrivals.Layout(f"{where}/new")]


_REASON = f"""CASE WHEN year(manufacturing_date) < {CHANGE} THEN NULL WHEN day(manufacturing_date) = 29 THEN 'manufacturing_date'
   WHEN day(occurrence_date) = 31 THEN 'claim_count' WHEN day(manufacturing_date) = 13 THEN 'plant' END"""


@query(
    "csv_round_trip",
    f"""SELECT plant, product_cat2, mid_category, CAST(year(manufacturing_date) AS INT) AS year, CAST(month(manufacturing_date) AS INT) AS month,
        count(*) AS n_rows, CAST(sum(claim_count) AS BIGINT) AS claim_count, CAST(sum(lag_days) AS BIGINT) AS lag_days
        FROM claims_d WHERE {_REASON} IS NULL GROUP BY ALL""",
)
def csv_round_trip(spark, sf_dir):
    claims = arrivals.accepted(arrivals.read_layouts(spark, two_layouts(spark, sf_dir, damaged=True)))
    made = F.col("manufacturing_date")
    return claims.groupBy("plant", "product_cat2", "mid_category", F.year(made).alias("year"), F.month(made).alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("claim_count").alias("claim_count"),
        F.sum(F.datediff("occurrence_date", made)).alias("lag_days"),
    )


@query(
    "csv_rejected",
    f"""SELECT {_REASON} AS reason, product_cat2, mid_category, count(*) AS n_rows FROM claims_d WHERE {_REASON} IS NOT NULL GROUP BY ALL""",
)
def csv_rejected(spark, sf_dir):
    left = arrivals.rejected(arrivals.read_layouts(spark, two_layouts(spark, sf_dir, damaged=True)))
    return left.groupBy("reason", "product_cat2", "mid_category").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "curated_build",
    """SELECT series_id, plant, product_cat2, mid_category, year, month, y AS claim_count, y > 0 AS has_claims,
       CAST(count_if(y > 0) OVER (PARTITION BY series_id) AS BIGINT) AS non_zero_records,
       sum(y) OVER (PARTITION BY series_id) AS total_claims FROM panel_d
       QUALIFY count_if(y > 0) OVER (PARTITION BY series_id) >= 10""",
)
def curated_build(spark, sf_dir):
    where = scratch(spark)
    layouts = two_layouts(spark, sf_dir, damaged=False)
    curate.build(spark, layouts, f"{where}/panel", f"{where}/documents", END, mode="legacy", start=START)
    stored = files.read_panel(spark, f"{where}/panel")
    header = files.read_documents(spark, f"{where}/documents").select("series_id", "non_zero_records", "total_claims")
    cells = stored.select("series_id", *panel.KEYS, "year", "month", "claim_count", (F.col("claim_count") > 0).alias("has_claims"))
    return cells.join(header, "series_id")


@query(
    "documents_json_round_trip",
    """SELECT series_id, plant, product_cat2, mid_category, year, month, y AS claim_count FROM panel_s
       QUALIFY count_if(y > 0) OVER (PARTITION BY series_id) >= 3""",
)
def documents_json_round_trip(spark, sf_dir):
    path = f"{scratch(spark)}/documents"
    files.write_documents(documents.series_documents(month_panel(spark, sf_dir, "sparse"), min_nonzero=3), path)
    good = arrivals.read_documents(spark, path).where(F.col(arrivals.MALFORMED).isNull())
    return documents.flat_panel(good).select("series_id", *panel.KEYS, "year", "month", "claim_count")


@query(
    "latest_file",
    """SELECT series_id, year, month, y AS claim_count FROM counts_s
       WHERE year * 100 + month = (SELECT max(year * 100 + month) FROM counts_s)""",
)
def latest_file(spark, sf_dir):
    folder = f"{scratch(spark)}/months"
    counts = panel.slot_counts(tables.claims(spark, sf_dir, "sparse")).select("series_id", "year", "month", "claim_count")
    named = counts.withColumn("candidates", F.format_string("%d_%02d", "year", "month"))
    named.repartition("candidates").write.partitionBy("candidates").parquet(folder)
    return arrivals.newest_month(spark, folder, spark.read.option("recursiveFileLookup", True).parquet)


@query(
    "month_increment",
    f"""SELECT c.series_id, c.plant, c.product_cat2, c.mid_category, count(*) AS records, sum(y) AS total_claims, max(y) AS max_claims,
        CAST(max(year * 100 + month) AS INT) AS last_month, any_value(l.series_id IS NOT NULL) AS redone
        FROM counts_s c LEFT JOIN (SELECT DISTINCT plant || '|' || product_cat2 || '|' || mid_category AS series_id FROM claims_s
          WHERE year(manufacturing_date) = {TWICE[0]} AND month(manufacturing_date) = {TWICE[1]} AND lag_days > {LATE_DAYS}) l USING (series_id)
        GROUP BY 1, 2, 3, 4""",
)
def month_increment(spark, sf_dir):
    where = scratch(spark)
    rows = tables.claims(spark, sf_dir, "sparse")
    made = F.col("manufacturing_date")
    this = (F.year(made) == TWICE[0]) & (F.month(made) == TWICE[1])
    cells = ("series_id", *panel.KEYS, "year", "month", "claim_count")
    early = rows.where(~this | (F.datediff("occurrence_date", made) <= LATE_DAYS))
    files.write_panel(panel.slot_counts(early).select(*cells), f"{where}/panel")
    increment.series_totals(files.read_panel(spark, f"{where}/panel")).write.parquet(f"{where}/totals")
    fresh = panel.slot_counts(rows.where(this)).select(*cells)
    return increment.replace_month(spark, f"{where}/panel", spark.read.parquet(f"{where}/totals"), fresh, *TWICE)
