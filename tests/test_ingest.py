import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelwright.functions import calendar
from panelwright.operators import lag, panel
from panelwright.schema import MissingColumn, normalise_columns
from panelwright.sources import files

CLAIMS = "plant string, product_cat2 string, mid_category string, occurrence_date date, manufacturing_date date, claim_count int"


def claim(day, made, count=1, plant="A", product="X", category="m"):
    return (plant, product, category, dt.date.fromisoformat(day), dt.date.fromisoformat(made), count)


def test_parse_dates_and_counts(spark):
    df = spark.createDataFrame([("2020-02-29", "1,234"), (" 20200301 ", " 7 "), ("nope", "x"), (None, None)], "d string, c string")
    rows = df.select(calendar.parse_date(F.col("d")).alias("d"), calendar.parse_count(F.col("c")).alias("c")).collect()
    assert [r.d for r in rows] == [dt.date(2020, 2, 29), dt.date(2020, 3, 1), None, None]
    assert [r.c for r in rows] == [1234, 7, 0, 0]


def test_iso_edges(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 31),), (dt.date(2021, 1, 1),), (dt.date(2021, 1, 4),)], "d date")
    rows = df.select(calendar.iso_year(F.col("d")).alias("y"), calendar.iso_week(F.col("d")).alias("w")).collect()
    assert [(r.y, r.w) for r in rows] == [(2020, 53), (2020, 53), (2021, 1)]


def test_week_53_years(spark):
    df = spark.range(1990, 2031).select(F.col("id").cast("int").alias("y"))
    got = {r.y for r in df.where(calendar.has_week_53(F.col("y"))).collect()}
    assert got == {y for y in range(1990, 2031) if dt.date(y, 12, 28).isocalendar()[1] == 53}


def test_week_month_is_capped(spark):
    rows = spark.range(1, 54).select("id", calendar.week_to_month(F.col("id")).alias("m")).collect()
    assert max(r.m for r in rows) == 12 and rows[0].m == 1


def test_month_steps_roll_over(spark):
    df = spark.sql("SELECT DATE '2023-11-15' AS d").select(calendar.month_steps(F.col("d"), 4).alias("s"))
    assert df.first().s == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_aliases(spark):
    df = spark.createDataFrame([(1, "p", 3)], ["﻿제조일자", " 플랜트 ", "count"])
    assert normalise_columns(df).columns == ["manufacturing_date", "plant", "claim_count"]
    with pytest.raises(MissingColumn):
        normalise_columns(df, required=("mid_category",))


def test_merge_sums_duplicates_across_files(spark):
    rows = [claim("2021-01-05", "2021-01-01", 2), claim("2021-01-05", "2021-01-01", 3), claim("2021-01-06", "2021-01-01", 1)]
    df = spark.createDataFrame(rows, CLAIMS)
    assert sorted(r.claim_count for r in panel.merge_duplicates(df).collect()) == [1, 5]
    report = {r.year: r for r in panel.duplicate_report(df).collect()}
    assert (report[None].rows_before, report[None].rows_after, report[2021].reduction) == (3, 2, 1)


def test_null_keys_are_left_out(spark):
    df = spark.createDataFrame([claim("2021-01-05", "2021-01-01"), (None, "X", "m", None, dt.date(2021, 1, 1), 9)], CLAIMS)
    assert [r.claim_count for r in panel.slot_counts(df).collect()] == [1.0]


def test_dense_panel_grid(spark):
    rows = [claim("2021-03-05", "2021-03-01", 12), claim("2022-05-05", "2022-05-01", 4), claim("2021-02-01", "2021-02-01", 3, plant="B")]
    counts = panel.slot_counts(spark.createDataFrame(rows, CLAIMS))
    out = panel.dense_panel(counts, end=(2022, 4)).collect()
    assert len(out) == 16 and {r.series_id for r in out} == {"A|X|m"}  # B is below the minimum
    assert (out[0].year, out[0].month) == (2021, 1) or min((r.year, r.month) for r in out) == (2021, 1)
    assert sum(r.claim_count for r in out) == 12  # the count after the end is lost
    assert sorted(r.idx for r in out) == list(range(16)) and {r.n for r in out} == {16}


def test_weekly_grid_has_53_weeks_unless_exact(spark):
    rows = [claim("2021-03-05", "2021-03-01", 1), claim("2020-03-05", "2020-03-02", 1)]
    counts = panel.slot_counts(spark.createDataFrame(rows, CLAIMS), slot="week")
    assert panel.dense_panel(counts, end=None, slot="week", min_claims=0).count() == 106
    assert panel.dense_panel(counts, end=None, slot="week", min_claims=0, iso_exact=True).count() == 105


def test_modal_class_ties_to_first_name(spark):
    rows = [claim("2021-01-05", "2021-01-01") + (c, w) for c, w in (("normal", 1.0), ("borderline", 0.5)) * 2]
    df = spark.createDataFrame(rows, CLAIMS + ", lag_class string, sample_weight double")
    got = panel.slot_counts(df, quality=True).first()
    assert (got.lag_class, got.sample_weight) == ("borderline", 0.75)
    p = panel.dense_panel(panel.slot_counts(df, quality=True), end=(2021, 2), min_claims=0).orderBy("idx").collect()
    assert (p[1].lag_class, p[1].sample_weight, p[1].claim_count) == ("normal", 1.0, 0.0)


def test_attach_quality_defaults(make_panel, spark):
    p = make_panel({"a": [1, 2]})
    meta = spark.createDataFrame([("P", "C", "M", 1998, 2, "borderline", 0.5)], "plant string, product_cat2 string, mid_category string, year int, month int, lag_class string, sample_weight double")
    got = panel.attach_quality(p, meta).orderBy("idx").collect()
    assert [(r.lag_class, r.sample_weight) for r in got] == [("normal", 1.0), ("borderline", 0.5)]


def lagged(spark, lags, product="X"):
    base = dt.date(2021, 1, 1)
    return [("A", product, "m", base + dt.timedelta(days=k), base, 1) for k in lags]


def test_lag_stats_small_categories_use_global(spark):
    rows = lagged(spark, range(30), "big") + lagged(spark, range(29), "small")
    freq = lag.lag_frequencies(spark.createDataFrame(rows, CLAIMS))
    got = {r.product_cat2: r for r in lag.lag_stats(freq).collect()}
    assert not got["big"].use_global and got["small"].use_global
    assert got["big"].mu == pytest.approx(14.5) and got["big"].sigma == pytest.approx((899 / 12) ** 0.5)
    everything = list(range(30)) + list(range(29))
    mean = sum(everything) / 59
    sample = (sum((x - mean) ** 2 for x in everything) / 58) ** 0.5
    assert got["small"].mu == pytest.approx(mean) and got["small"].sigma == pytest.approx(sample)


def test_lag_labels_at_the_limits(spark):
    stats = spark.createDataFrame([("X", 10.0, 5.0)], "product_cat2 string, mu double, sigma double")
    fallback = spark.createDataFrame([(100.0, 1.0)], "mu double, sigma double")
    rows = lagged(spark, [-1, 0, 15, 16, 20, 21]) + lagged(spark, [101, 102, 103], "unknown")
    rows.append(("A", "X", "m", None, dt.date(2021, 1, 1), 1))
    got = lag.label_lags(spark.createDataFrame(rows, CLAIMS), stats, fallback).collect()
    label = {(r.product_cat2, r.lag_days): r.lag_class for r in got}
    assert [label["X", k] for k in (-1, 0, 15, 16, 20, 21)] == ["invalid_negative", "normal", "normal", "borderline", "borderline", "extreme"]
    assert [label["unknown", k] for k in (101, 102, 103)] == ["normal", "borderline", "extreme"]
    assert label["X", None] == "extreme"


def test_iqr_filter_spares_small_products(spark):
    rows = lagged(spark, [1] * 8 + [1000], "nine") + lagged(spark, [1] * 9 + [1000], "ten")
    df = lag.with_lag_days(spark.createDataFrame(rows, CLAIMS))
    kept = lag.within_bounds(df, lag.iqr_bounds(lag.lag_frequencies(df)))
    assert {r.product_cat2: r.n for r in kept.groupBy("product_cat2").agg(F.count("*").alias("n")).collect()} == {"nine": 9, "ten": 9}


def test_one_hot_category_gives_exact_quantiles(spark):
    df = spark.range(200_000).select(
        F.lit("hot").alias("product_cat2"), (F.col("id") % 1000).cast("int").alias("lag_days")
    )
    freq = lag.lag_frequencies(df)
    assert freq.count() == 1000
    got = lag.lag_stats(freq).first()
    assert got.p90 == pytest.approx(899.1, abs=1.0) and got.n == 200_000


def test_small_joins_are_broadcast_only_below_the_limit(spark):
    from panelwright.operators.sizing import join_small

    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    fits, beyond = join_small(big, small, "k"), join_small(big, small, "k", max_rows=5)
    assert sorted(map(tuple, fits.collect())) == sorted(map(tuple, beyond.collect()))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(fits) and "broadcast" not in plan(beyond)


def test_upserts_are_idempotent(make_panel):
    master = make_panel({"a": [1, 2, 3]}).select("series_id", "year", "month", "claim_count")
    fresh = make_panel({"a": [0, 0, 9], "b": [0, 0, 5]}).select("series_id", "year", "month", "claim_count").where("month = 3")
    once = panel.upsert_month(master, fresh, 1998, 3)
    twice = panel.upsert_month(once, fresh, 1998, 3)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert {(r.series_id, r.claim_count) for r in twice.where("month = 3").collect()} == {("a", 9.0), ("b", 5.0)}
    keyed = {(r.series_id, r.month): r.claim_count for r in panel.upsert_keyed(master, fresh).collect()}
    assert keyed == {("a", 1): 1.0, ("a", 2): 2.0, ("a", 3): 9.0, ("b", 3): 5.0}


def test_reindex_gives_every_series_all_periods(make_panel):
    p = make_panel({"a": [1, 2, 3]}).unionByName(make_panel({"b": [7]}, start=(1998, 6)))
    got = panel.reindex_observed(p)
    assert got.count() == 8
    assert {r.claim_count for r in got.where("series_id = 'b'").collect()} == {0.0, 7.0}


def test_csv_round_trip_and_encodings(spark, tmp_path):
    body = "발생일자,중분류(보정),플랜트,제품범주2,제조일자,count\n2021-01-05,맛,서울,면,20210101,\"1,200\"\n2021-01-06,맛,서울,면,bad,3\n"
    for name, encoding in (("utf8.csv", "utf-8-sig"), ("latin.csv", "utf-8")):
        (tmp_path / name).write_bytes(body.encode(encoding))
        got = files.typed_claims(files.read_claim_csv(spark, str(tmp_path / name))).orderBy("claim_count").collect()
        assert [r.claim_count for r in got] == [3, 1200] and got[1].plant == "서울"
        assert got[0].manufacturing_date is None
    bad = files.bad_dates(files.read_claim_csv(spark, str(tmp_path / "utf8.csv"))).first()
    assert bad.n_bad == 1 and bad.examples == ["bad"]
    with pytest.raises(Exception, match="unreadable"):
        files.read_claims_strict(spark, str(tmp_path / "utf8.csv")).collect()


def test_union_of_differing_layouts(spark):
    a = spark.createDataFrame([("A", 1)], "plant string, claim_count int")
    b = spark.createDataFrame([("B", "m", 2)], "plant string, mid_category string, claim_count int")
    got = files.union_years([a, b])
    assert set(got.columns) == {"plant", "mid_category", "claim_count"} and got.count() == 2


def test_panel_and_documents_on_disk(spark, make_panel, tmp_path):
    from panelwright.operators import documents

    p = make_panel({"a": list(range(12)), "b": [0] * 11 + [1]})
    files.write_panel(p, str(tmp_path / "panel"))
    back = files.read_panel(spark, str(tmp_path / "panel"), (1998, 1998))
    assert back.count() == 24
    plan = back.where("month = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan
    docs = documents.series_documents(back)
    assert [r.series_id for r in docs.collect()] == ["a"]
    files.write_documents(docs, str(tmp_path / "docs"))
    flat = documents.flat_panel(files.read_documents(spark, str(tmp_path / "docs")))
    assert sorted(r.claim_count for r in flat.collect()) == [float(v) for v in range(12)]


def test_latest_month_file(spark, tmp_path):
    for stamp, v in (("2023_11", 1), ("2024_01", 2), ("202312", 3)):
        spark.range(1).select(F.lit(v).alias("v")).coalesce(1).write.parquet(str(tmp_path / f"forecast_{stamp}"))
    df = spark.read.parquet(*[str(p) for p in tmp_path.iterdir()])
    assert df.count() == 3
    (tmp_path / "x").mkdir()
    for stamp in ("2023_11", "2024_01"):
        (tmp_path / "x" / f"scores_{stamp}.csv").write_text(f"v\n{stamp}\n")
    csv = spark.read.option("header", True).csv(str(tmp_path / "x"))
    assert [r.v for r in files.latest_month(csv).collect()] == ["2024_01"]
