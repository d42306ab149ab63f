"""Registration of the checked queries and the inputs they share.

Every query reads the given tables whole.  The SQL twin starts from the same claims view; its common
table expressions are written once here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.columns import round_all
from panelwright.operators import accuracy, forecast, panel
from panelwright.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The months of the tables; the last six are held out.
START, TRAIN_END, END = (1995, 1), (2001, 2), (2001, 8)
HORIZON = 6
SLOTS = (END[0] - START[0]) * 12 + END[1] - START[1] + 1
TRAIN_SLOTS = SLOTS - HORIZON
#: Positions at which the last year and the last half year of the history begin.
LAST_YEAR, LAST_HALF = TRAIN_SLOTS - 12, TRAIN_SLOTS - 6
#: The same positions in the SQL twins.
POSITIONS = {"@slots": SLOTS, "@train": TRAIN_SLOTS, "@year": LAST_YEAR, "@half": LAST_HALF, "@start": START[0]}
MIN_CLAIMS = 10


def positioned(sql: str) -> str:
    for name, value in POSITIONS.items():
        sql = sql.replace(name, str(value))
    return sql


def query(name: str, oracle: str | None = None, doubles: str = ""):
    """Register a query; `doubles` lists the SQL columns to round as the Spark side does."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: round_all(fn(spark, sf_dir))
        if oracle is not None:
            cols = doubles.split()
            fixed = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in cols)
            replaced = f"SELECT * REPLACE ({fixed})" if cols else "SELECT *"
            ORACLES[name] = positioned(f"{PRELUDE}\n{replaced} FROM (\n{oracle}\n)")
        return fn

    return register


# --- shared Spark inputs --------------------------------------------------------------------------


def month_panel(spark: SparkSession, sf_dir: str, grain: str = "dense") -> DataFrame:
    """Monthly panel over all months by manufacture date."""
    counts = panel.slot_counts(tables.claims(spark, sf_dir, grain))
    return panel.dense_panel(counts, end=END, start=START, min_claims=MIN_CLAIMS)


def history(p: DataFrame) -> DataFrame:
    """All months but the held-out ones, with `n` as their number."""
    return p.where(F.col("idx") < TRAIN_SLOTS).withColumn("n", F.lit(TRAIN_SLOTS))


def actuals(p: DataFrame) -> DataFrame:
    """The held-out months."""
    return p.where(F.col("idx") >= TRAIN_SLOTS)


def naive(p: DataFrame) -> DataFrame:
    return forecast.seasonal_naive(history(p), HORIZON, 12)


def comparison(spark: SparkSession, sf_dir: str, grain: str = "dense") -> DataFrame:
    """Actuals of the last 6 months with the seasonal naive forecast of them."""
    p = month_panel(spark, sf_dir, grain)
    return accuracy.compare_inner(actuals(p), naive(p))


def holdout_errors(p: DataFrame) -> DataFrame:
    """WMAPE per series of the seasonal naive forecast of the last 6 history months."""
    train = p.where(F.col("idx") < LAST_HALF).withColumn("n", F.lit(LAST_HALF))
    test = p.where(F.col("idx").between(LAST_HALF, TRAIN_SLOTS - 1))
    predicted = forecast.seasonal_naive(train, HORIZON, 12)
    return accuracy.metrics_by(accuracy.compare_inner(test, predicted), "series_id")


# --- shared SQL -----------------------------------------------------------------------------------

_CLAIMS = """
claims_{g} AS (
  SELECT {plant} AS plant, {product} AS product_cat2, l_returnflag AS mid_category,
         CAST(l_shipdate AS DATE) AS occurrence_date, CAST(o_orderdate AS DATE) AS manufacturing_date,
         {count} AS claim_count,
         date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lag_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
counts_{g} AS (
  SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, plant, product_cat2, mid_category,
         CAST(year(manufacturing_date) AS INT) AS year, CAST(month(manufacturing_date) AS INT) AS month,
         CAST((year(manufacturing_date) - @start) * 12 + month(manufacturing_date) - 1 AS INT) AS idx,
         CAST(sum(claim_count) AS DOUBLE) AS y
  FROM claims_{g} GROUP BY ALL
),
series_{g} AS (
  SELECT series_id, plant, product_cat2, mid_category FROM counts_{g} GROUP BY ALL HAVING sum(y) >= 10
),
panel_{g} AS (
  SELECT s.*, CAST(@start + g.i // 12 AS INT) AS year, CAST(g.i % 12 + 1 AS INT) AS month, CAST(g.i AS INT) AS idx,
         coalesce(c.y, 0.0) AS y
  FROM series_{g} s CROSS JOIN range(@slots) g(i) LEFT JOIN counts_{g} c ON c.series_id = s.series_id AND c.idx = g.i
),
hist_{g} AS (SELECT *, @train AS n FROM panel_{g} WHERE idx < @train),
act_{g} AS (SELECT * FROM panel_{g} WHERE idx >= @train),
fc_{g} AS (
  SELECT b.series_id, b.idx - @year + 1 AS h, CAST(b.idx + 12 AS INT) AS idx, CAST(@start + (b.idx + 12) // 12 AS INT) AS year,
         CAST(b.idx % 12 + 1 AS INT) AS month, b.y AS y_pred, b.y - 1.96 * s.sd AS y_pred_lower, b.y + 1.96 * s.sd AS y_pred_upper
  FROM hist_{g} b JOIN (SELECT series_id, stddev_pop(y) AS sd FROM hist_{g} WHERE idx >= @year GROUP BY 1) s USING (series_id)
  WHERE b.idx BETWEEN @year AND @year + 5
),
cmp_{g} AS (
  SELECT a.series_id, a.year, a.month, a.idx, a.y, f.y_pred, f.y_pred_lower, f.y_pred_upper, a.y - f.y_pred AS e
  FROM act_{g} a JOIN fc_{g} f USING (series_id, idx)
),
holdout_{g} AS (
  SELECT t.series_id, 100 * sum(abs(t.y - b.y)) FILTER (t.y > 0) / sum(t.y) FILTER (t.y > 0) AS wmape
  FROM hist_{g} t JOIN hist_{g} b ON b.series_id = t.series_id AND b.idx = t.idx - 12
  WHERE t.idx BETWEEN @half AND @train - 1 GROUP BY 1
)"""

PRELUDE = "WITH " + ",".join(
    [
        _CLAIMS.format(g="d", plant="r_name", product="p_type", count="CAST(l_quantity AS INT)"),
        _CLAIMS.format(g="s", plant="n_name", product="p_brand", count="1"),
    ]
)
