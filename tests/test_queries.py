"""Every registered query against its SQL twin on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# the corpus operators have their own tests
from panelwright import catalog  # noqa: E402

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return con


def canonical(rows):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            return str(v)
        return repr(float(v))

    return sorted(tuple(cell(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, connection):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [[row[names.index(c)] for c in columns] for row in result.fetchall()]
    got = [[row[c] for c in columns] for row in df.collect()]
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark):
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() > 0


def test_entry(spark):
    report = entry.entry(spark)
    assert report.columns[:2] == ["rank", "series_id"] and report.count() > 0
