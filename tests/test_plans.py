import datetime as dt

import numpy as np
import pytest
from helpers import by_id
from pyspark.sql import functions as F

from panelwright.config import OrderGrid
from panelwright.operators import documents, lag, panel, reports, seasonal_models
from panelwright.plans import curate, monthly, training
from panelwright.sources import files
from panelwright.streaming import month_files

HEADER = "occurrence_date,mid_category,plant,product_cat2,manufacturing_date,claim_count\n"
GRID = OrderGrid(1, 1, 0, 0, (0,))


def csv(path, rows):
    path.write_text(HEADER + "".join(",".join(map(str, r)) + "\n" for r in rows))


def rows_of(month, counts, year=2024, plant="A"):
    return [(f"{year}-{month:02d}-{d + 10}", "m", plant, "X", f"{year}-{month:02d}-0{d + 1}", c) for d, c in enumerate(counts)]


def months(spark, path):
    p = spark.read.parquet(path)
    return {(r.series_id, r.year, r.month): r.claim_count for r in p.collect()}


def run(spark, folder, out, progress):
    month_files.ingest_months(month_files.month_stream(spark, str(folder)), str(out), str(progress)).awaitTermination()


def test_stream_replaces_months(spark, tmp_path):
    inbox, out, progress = tmp_path / "in", tmp_path / "panel", tmp_path / "progress"
    inbox.mkdir()
    csv(inbox / "jan.csv", rows_of(1, [1, 2]))
    csv(inbox / "feb.csv", rows_of(2, [5]) + rows_of(2, [7], plant="B"))
    run(spark, inbox, out, progress)
    assert months(spark, str(out)) == {("A|X|m", 2024, 1): 3.0, ("A|X|m", 2024, 2): 5.0, ("B|X|m", 2024, 2): 7.0}
    # a new delivery of February, with one stray January row that must not touch January
    csv(inbox / "feb_again.csv", rows_of(2, [4, 4]) + rows_of(1, [99]))
    run(spark, inbox, out, progress)
    assert months(spark, str(out)) == {("A|X|m", 2024, 1): 3.0, ("A|X|m", 2024, 2): 8.0}
    run(spark, inbox, out, progress)  # nothing new: nothing changes
    assert len(months(spark, str(out))) == 2


def test_stream_unites_part_files(spark, tmp_path):
    """A folder of part files is one delivery; a later folder for the month replaces it; stray rows are counted."""
    inbox, out, progress = tmp_path / "in", tmp_path / "panel", tmp_path / "progress"
    for name in ("jan", "feb"):
        (inbox / name).mkdir(parents=True)
    csv(inbox / "jan" / "part-0.csv", rows_of(1, [1, 2]))
    csv(inbox / "jan" / "part-1.csv", rows_of(1, [4]) + rows_of(1, [8], plant="B"))
    csv(inbox / "feb" / "part-0.csv", rows_of(2, [5, 5]) + rows_of(1, [99]))
    run(spark, inbox, out, progress)
    assert months(spark, str(out)) == {("A|X|m", 2024, 1): 7.0, ("B|X|m", 2024, 1): 8.0, ("A|X|m", 2024, 2): 10.0}
    dropped = [(r.delivery.rsplit("/", 1)[1], r.year, r.month, r.rows) for r in spark.read.parquet(f"{out}_dropped").collect()]
    assert dropped == [("feb", 2024, 1, 1)]
    (inbox / "jan_again").mkdir()
    csv(inbox / "jan_again" / "part-0.csv", rows_of(1, [3]))
    csv(inbox / "jan_again" / "part-1.csv", rows_of(1, [6]))
    run(spark, inbox, out, progress)
    assert months(spark, str(out)) == {("A|X|m", 2024, 1): 9.0, ("A|X|m", 2024, 2): 10.0}


def test_stream_reads_bad_rows(spark, tmp_path):
    inbox, out = tmp_path / "in", tmp_path / "panel"
    inbox.mkdir()
    csv(inbox / "a.csv", rows_of(3, [1, 1]) + [("2024-03-01", "m", "A", "X", "not a date", 50), ("2024-03-01", "m", "A", "X", "20240309", "x")])
    run(spark, inbox, out, tmp_path / "progress")
    assert months(spark, str(out)) == {("A|X|m", 2024, 3): 2.0}


def test_build_from_files(spark, tmp_path):
    for year in (2021, 2022):
        rows = [r for m in range(1, 13) for r in rows_of(m, [3, 2], year)]
        csv(tmp_path / f"{year}_raw.csv", rows)
    paths = files.year_paths(str(tmp_path), [2021, 2022])
    curate.build(spark, paths, str(tmp_path / "panel"), str(tmp_path / "docs"), end=(2022, 12))
    docs = files.read_documents(spark, str(tmp_path / "docs")).collect()
    assert len(docs) == 1 and docs[0].records == 24 and docs[0].total_claims == 120.0
    assert docs[0].quality_stats.normal_ratio + docs[0].quality_stats.borderline_ratio == pytest.approx(1.0)
    legacy = curate.curated_panel(files.typed_claims(files.read_claim_csv(spark, paths)), (2022, 12), mode="legacy")
    assert "lag_class" not in legacy.columns and legacy.count() == 24
    with pytest.raises(ValueError):
        curate.curated_panel(legacy, (2022, 12), mode="other")


def claims_frame(spark, rows):
    return spark.createDataFrame(
        [(p, "X", "m", dt.date.fromisoformat(o), dt.date.fromisoformat(m), c) for o, p, m, c in rows],
        "plant string, product_cat2 string, mid_category string, occurrence_date date, manufacturing_date date, claim_count int",
    )


def test_month_update_keeps_only_its_month(spark, make_panel):
    master = make_panel({"A|X|m": [4, 5, 6]}, start=(2024, 1)).select("series_id", *panel.KEYS, "year", "month", "claim_count")
    upload = claims_frame(spark, [("2024-03-20", "A", "2024-03-01", 9), ("2024-03-21", "A", "2024-02-27", 8), ("2024-03-22", "B", "2024-03-02", 1)])
    assert tuple(monthly.dropped_rows(upload, 2024, 3).first()) == (1, 2)
    updated, viable = monthly.update_master(master, upload, 2024, 3)
    assert {(r.series_id, r.month): r.claim_count for r in updated.collect()} == {("A|X|m", 1): 4.0, ("A|X|m", 2): 5.0, ("A|X|m", 3): 9.0, ("B|X|m", 3): 1.0}
    assert [r.series_id for r in viable.collect()] == ["A|X|m"]


def test_documents_are_refreshed(make_panel):
    docs = documents.series_documents(make_panel({"A|X|m": list(range(1, 13))}, start=(2024, 1)))
    fresh = make_panel({"A|X|m": [50.0]}, start=(2024, 12)).unionByName(make_panel({"A|X|m": [7.0]}, start=(2025, 1)))
    got = monthly.refresh_documents(docs, fresh).first()
    assert [d.claim_count for d in got.data][-2:] == [50.0, 7.0] and got.records == 13


def test_six_steps_of_a_month(spark, make_panel, tmp_path):
    rng = np.random.default_rng(0)
    history = make_panel({"A|X|m": rng.poisson(20, 36), "B|X|m": rng.poisson(20, 36)}, start=(2021, 1))
    upload = claims_frame(spark, [("2024-01-20", p, "2024-01-01", c) for p, c in (("A", 20), ("B", 90))])
    base = claims_frame(spark, [("2023-01-20", "A", f"2023-01-{d:02d}", 1) for d in range(1, 19)])
    freq = lag.lag_frequencies(base)
    f = spark.createDataFrame([("A|X|m", 2024, 1, 20.0), ("B|X|m", 2024, 1, 20.0)], "series_id string, year int, month int, y_pred double")
    models = spark.createDataFrame([("A|X|m",), ("B|X|m",)], "series_id string").withColumn("order", seasonal_models.order_column((1, 0, 0, 0, 0, 0, 12)))
    stats = lag.lag_stats(freq, min_rows=1).withColumn("mu", F.lit(30.0))
    out = monthly.process_month(upload, stats, lag.global_lag_stats(freq), f, history, models, 2024, 1, GRID)
    assert out["comparison"].count() == 2
    assert [r.series_id for r in out["models"].collect()] == ["B|X|m"]
    assert out["forecast"].count() == 6
    monthly.log_month(out["log"], str(tmp_path / "log"))
    monthly.log_month(out["log"], str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_training_run_and_forecast(make_panel):
    rng = np.random.default_rng(1)
    h = make_panel({"a": rng.poisson(20, 36), "b": rng.poisson(5, 36), "thin": [0] * 35 + [1]})
    out = training.train_base(h, "run-1", GRID)
    assert {r.status: r.n for r in out["status"].collect()} == {"success": 2, "skipped": 1}
    assert out["kpi"].first().n_series == 2
    keys = {r.key for r in out["manifest"].collect()}
    assert {"data_hash", "seed", "candidates", "duration_sec"} <= keys
    ahead = training.forecast_next(h, out["models"])
    tags = {r.series_id: r.model for r in ahead.collect()}
    assert tags == {"a": "seasonal_arma", "b": "seasonal_arma", "thin": "naive_seasonal"} and ahead.count() == 18
    assert reports.best_models(out["models"], "aic", 1).count() == 1
    assert training.evaluate_years(make_panel({"a": rng.poisson(20, 48)}), 2001, 2001).count() == 1


def test_series_list_filters(make_panel, tmp_path, spark):
    p = make_panel({"a": [1], "b": [2]})
    panel.save_series_list(p.where("series_id = 'b'"), str(tmp_path / "ids"))
    assert by_id(panel.only_series(p, spark.read.parquet(str(tmp_path / "ids"))), "claim_count") == {"b": 2.0}


def test_tuning_takes_the_worst_first(make_panel, spark):
    rng = np.random.default_rng(2)
    h = make_panel({s: rng.poisson(20, 48) for s in ("fine", "bad", "worse")})
    metrics = spark.createDataFrame([("fine", 0.1, 0.0, 1.0), ("bad", 0.3, 0.0, 1.0), ("worse", 0.9, 0.2, 2.0)], "series_id string, mape double, bias double, mase double")
    assert {r.series_id for r in training.tune_poor(h, metrics, GRID).collect()} == {"bad", "worse"}
    one = training.tune_poor(h, metrics, GRID, most=1).first()
    assert one.series_id == "worse" and one.original_mase == 2.0


def test_model_documents_read_back(spark, tmp_path):
    doc = '{"series_id": "a", "status": "success", "model_type": "m", "n_train_points": 5, "guard_results": {"is_sparse": false, "zero_ratio": 0.1, "has_drift": false, "has_seasonality": true, "seasonality_strength": 0.5}, "historical_stats": {"mean": 2.0, "std": 1.0, "nonzero_pct": 90.0}}'
    (tmp_path / "models.json").write_text(doc + "\n" + doc.replace("success", "failed") + "\n")
    got = documents.flat_models(files.read_models(spark, str(tmp_path / "models.json"))).collect()
    assert len(got) == 1 and got[0].predictability_score == 0.5 and got[0].has_seasonality


def test_ledger_across_batches(spark, tmp_path):
    """Parts of a delivery in different batches add up; a month whose delivery turns out to stand for another goes."""
    inbox, out, progress = tmp_path / "in", tmp_path / "panel", tmp_path / "progress"
    for name in ("jan", "two"):
        (inbox / name).mkdir(parents=True)
    csv(inbox / "jan" / "part-0.csv", rows_of(1, [1, 2]))
    csv(inbox / "two" / "part-0.csv", rows_of(5, [7]))
    run(spark, inbox, out, progress)
    assert months(spark, str(out)) == {("A|X|m", 2024, 1): 3.0, ("A|X|m", 2024, 5): 7.0}
    csv(inbox / "jan" / "part-1.csv", rows_of(1, [4]) + rows_of(1, [8], plant="B"))
    csv(inbox / "two" / "part-1.csv", rows_of(6, [1, 1]))  # now mostly June: its May row is stray
    run(spark, inbox, out, progress)
    want = {("A|X|m", 2024, 1): 7.0, ("B|X|m", 2024, 1): 8.0, ("A|X|m", 2024, 6): 2.0}
    assert months(spark, str(out)) == want
    dropped = [(r.delivery.rsplit("/", 1)[1], r.month, r.rows, r.reason) for r in spark.read.parquet(f"{out}_dropped").collect()]
    assert dropped == [("two", 5, 1, "stray")]
    # a batch replayed changes nothing
    stream = month_files.month_stream(spark, str(inbox))
    replay = spark.read.schema(stream.drop("_file", "_at").schema).option("header", True).csv([str(inbox / "jan" / "part-1.csv"), str(inbox / "two" / "part-1.csv")])
    from pyspark.sql import functions as F

    replay = replay.select("*", month_files.delivery(str(inbox), F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.file_modification_time").alias("_at"))
    month_files.replace_months(str(out))(replay, 1)
    assert months(spark, str(out)) == want


def test_one_file_a_batch(spark, tmp_path):
    inbox, out = tmp_path / "in", tmp_path / "panel"
    (inbox / "jan").mkdir(parents=True)
    for k in range(4):
        csv(inbox / "jan" / f"part-{k}.csv", rows_of(1, [k + 1]))
    stream = month_files.month_stream(spark, str(inbox), files_per_batch=1)
    month_files.ingest_months(stream, str(out), str(tmp_path / "progress")).awaitTermination()
    assert months(spark, str(out)) == {("A|X|m", 2024, 1): 10.0}
