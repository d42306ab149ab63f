import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def panel_rows(spark, series, start=(1998, 1)):
    """Positioned monthly panel from {series_id: values}."""
    rows = []
    for sid, values in series.items():
        for i, v in enumerate(values):
            k = start[0] * 12 + start[1] - 1 + i
            rows.append((sid, "P", "C", "M", k // 12, k % 12 + 1, i, len(values), None if v is None else float(v)))
    return spark.createDataFrame(
        rows,
        "series_id string, plant string, product_cat2 string, mid_category string, year int, month int, idx int, n int, claim_count double",
    )


@pytest.fixture(scope="session")
def make_panel(spark):
    return lambda series, start=(1998, 1): panel_rows(spark, series, start)
