"""Files of several layouts, damaged rows and documents, the newest month, a month carried through."""

import pytest
from pyspark.sql import functions as F

from panelwright.operators import panel
from panelwright.plans import curate, increment
from panelwright.sources import arrivals, files

HEAD = "claim_date,production_date,plant,product_cat2,mid_category,count"


def put(path, *lines, encoding="utf-8"):
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return str(path)


@pytest.fixture
def raw(spark, tmp_path):
    a = put(
        tmp_path / "2021.csv",
        HEAD,
        '2021-02-01,2021-01-05, P ,C,M,"1,200"',
        "2021-02-01,20210105,P,C,M,3",
        "2021-02-01,05/01/2021,P,C,M,1",
        "2021-02-01,,P,C,M,1",
        "2021-02-01,2021-01-05,P,C,M,many",
        "2021-02-01,2021-01-05,,C,M,1",
        "2021-02-01,2021-01-05,P,C",
        "2021-02-01,2021-01-05,P,C,M,1,extra",
    )
    b = put(tmp_path / "2022.csv", "﻿플랜트;중분류;제품범주2;제조일자;건수;y", "Q;M;C;20220301;x;7")
    return arrivals.read_layouts(spark, [arrivals.Layout(a), arrivals.Layout(b, sep=";")])


def test_layouts_become_one_table(raw):
    rows = arrivals.accepted(raw).orderBy("manufacturing_date", F.desc("claim_count")).collect()
    assert [(r.plant, r.mid_category, str(r.manufacturing_date), r.claim_count) for r in rows] == [
        ("P", "M", "2021-01-05", 1200),
        ("P", "M", "2021-01-05", 3),
        ("Q", "M", "2022-03-01", 7),
    ]
    assert rows[2].occurrence_date is None  # the second layout has no such column


def test_rejected_rows_keep_text_and_reason(raw):
    left = arrivals.rejected(raw).collect()
    assert sorted(r.reason for r in left) == ["claim_count", "malformed", "malformed", "manufacturing_date", "manufacturing_date", "plant"]
    assert {r.source_file for r in left} == {"2021.csv"}
    assert "2021-02-01,2021-01-05,P,C" in [r.malformed for r in left]
    assert [r.manufacturing_date for r in left if r.reason == "manufacturing_date"].count(None) == 1
    assert arrivals.accepted(raw).count() + len(left) == raw.count() == 9


def test_another_header_is_not_read_by_position(spark, tmp_path):
    put(tmp_path / "a.csv", HEAD, *["2021-02-01,2021-01-05,P,C,M,1"] * 2)
    put(tmp_path / "b.csv", "production_date,claim_date,plant,product_cat2,mid_category,count", "2021-01-05,2021-02-01,P,C,M,1")
    with pytest.raises(Exception, match="(?i)header"):
        arrivals.read_layout(spark, arrivals.Layout(str(tmp_path))).collect()


def test_build_writes_the_rejected_rows(spark, tmp_path):
    lines = [f"2022-{m:02d}-20,2022-{m:02d}-05,P,C,M,2" for m in range(1, 13)]
    path = put(tmp_path / "y.csv", HEAD, *lines, "2022-01-20,never,P,C,M,2")
    where = {n: str(tmp_path / n) for n in ("panel", "documents", "rejected")}
    curate.build(spark, [arrivals.Layout(path)], where["panel"], where["documents"], (2022, 12), mode="legacy", rejected_path=where["rejected"])
    assert files.read_panel(spark, where["panel"]).agg(F.sum("claim_count")).first()[0] == 24
    assert [r.reason for r in spark.read.parquet(where["rejected"]).collect()] == ["manufacturing_date"]


def test_broken_documents_are_set_aside(spark, tmp_path):
    put(tmp_path / "d.json", '{"series_id": "a", "records": 2, "data": [{"year": 2020, "month": 1, "claim_count": 3.0}]}', '{"series_id": "b", "rec')
    rows = {r.series_id: r.malformed for r in arrivals.read_documents(spark, str(tmp_path)).collect()}
    assert rows["a"] is None
    assert [v for v in rows.values() if v] == ['{"series_id": "b", "rec']


@pytest.mark.parametrize(
    "name, stamp",
    [("2024_01.csv", 202401), ("candidates_202312.csv", 202312), ("x-2024-01-15.json", 202401), ("20240115", 202401), ("part-00012345", 0), ("2024_13", 0), ("none", 0)],
)
def test_month_stamp(spark, name, stamp):
    assert spark.range(1).select(arrivals.month_stamp(F.lit(name))).first()[0] == stamp


def test_newest_month_opens_its_files_only(spark, tmp_path):
    for name in ("c_2023_12", "c_2024_01", "c_2023_11"):
        (tmp_path / name).mkdir()
        put(tmp_path / name / "part-0.csv", "v", name)
    put(tmp_path / "c_2023_10.csv", "v", "file")
    newest = arrivals.newest_month(spark, str(tmp_path), lambda p: spark.read.option("recursiveFileLookup", True).option("header", True).csv(p))
    assert [r.v for r in newest.collect()] == ["c_2024_01"]
    assert newest.rdd.getNumPartitions() == 1


def counts(spark, rows):
    return spark.createDataFrame(
        [(s, "P", "C", s, y, m, float(v)) for s, y, m, v in rows],
        "series_id string, plant string, product_cat2 string, mid_category string, year int, month int, claim_count double",
    )


def test_a_replaced_month_is_carried_through(spark, tmp_path):
    path = str(tmp_path / "panel")
    before = [("a", 2020, 1, 1), ("a", 2020, 2, 5), ("b", 2020, 1, 4), ("b", 2020, 2, 4), ("c", 2020, 2, 2), ("e", 2020, 1, 8), ("e", 2020, 2, 1)]
    after = [("a", 2020, 2, 9), ("b", 2020, 2, 4), ("d", 2020, 2, 3)]  # a changes, b stays, c and e go, d comes
    files.write_panel(counts(spark, before), path)
    totals = increment.series_totals(counts(spark, before))
    whole = panel.upsert_month(counts(spark, before), counts(spark, after), 2020, 2)
    want = {r.series_id: r for r in increment.series_totals(whole).collect()}
    for attempt in range(2):  # the second run, after the replacement, finds no difference but the list
        got = {r.series_id: r for r in increment.replace_month(spark, path, totals, counts(spark, after), 2020, 2).collect()}
        assert set(got) == set(want) == {"a", "b", "d", "e"}
        for s, r in want.items():
            assert all(got[s][c] == r[c] for c in r.asDict())
        assert {s for s, r in got.items() if r.redone} == {"a", "d", "e"}
