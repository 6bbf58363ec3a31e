"""The learner by behaviour: it beats the mean on a learnable series; reports are whole."""

import json
import math

import pytest
from pyspark.sql import functions as F

from loadweave.__main__ import main
from loadweave.operators import evaluation, forecasting
from loadweave.session import scratch_path
from loadweave.settings import Settings
from loadweave.sources import sinks
from tests.helpers import SIX, hourly, same

SMALL = Settings(trees=25, tree_depth=3, patience=5)


def daily_wave(spark, n):
    wave = F.sin(F.lit(2 * math.pi / 24) * F.col("sequence_id"))
    zones = [(F.lit(1000.0 * (i + 2)) + wave * (100.0 * (i + 1))).alias(z) for i, z in enumerate(SIX.zones)]
    return hourly(spark, n).select("panel_id", "sequence_id", "ts", *zones)


@pytest.fixture(scope="module")
def trained(spark):
    panel = daily_wave(spark, 700).drop("sequence_id").cache()
    return panel, *forecasting.train(panel, SIX, SMALL)


def test_folds(trained):
    _, fitted, baselines = trained
    rows = fitted.folds.orderBy("fold").collect()
    n = 560 - 169
    assert fitted.n_rows == n
    assert [r.train_rows for r in rows] == [n // 5 * f for f in range(1, 5)]
    assert rows[-1].val_rows == n - n // 5 * 4
    assert baselines.count() == 3
    assert all(r.best_iteration > 1 for r in rows)


def test_patience():
    assert forecasting.best_iteration([5, 4, 3, 3.5, 3.6, 1], patience=2) == 3
    assert forecasting.best_iteration([5, 4, 3, 3.5, 1], patience=2) == 5
    assert forecasting.best_iteration([5], patience=2) == 1


def test_model_learns_and_reloads(spark, trained):
    panel, fitted, _ = trained
    path = scratch_path(spark, "model")
    sinks.save_model(fitted.model, path)
    model = sinks.load_model(spark, path)
    held = forecasting.holdout_features(panel, SIX, SMALL)
    assert held.count() == 0  # 140 rows of its own are fewer than the warm-up of 169
    carried = forecasting.holdout_features(panel, SIX, SMALL, carry_history=True)
    assert carried.count() == 139
    results = forecasting.forecast(carried, model, SIX, SMALL)
    error = evaluation.error_table(results, [], "load_actual_mw", "load_forecast_mw").first()
    spread = carried.agg(F.avg(F.abs(F.col("target") - F.lit(2000.0)))).first()[0]
    assert error.mae < spread / 2
    persistence = carried.agg(F.avg(F.abs(F.col("target") - F.col("pjme")))).first()[0]
    assert error.mae < persistence / 2
    same(
        forecasting.score(carried, fitted.model).select("ts", "prediction"),
        forecasting.score(carried, model).select("ts", "prediction"),
    )
    same_row = forecasting.forecast(carried, model, SIX, SMALL, align="same_row")
    joined = same_row.join(panel, ["panel_id", "ts"])
    assert joined.filter("load_actual_mw != pjme").count() == 0


def test_importances(spark, trained):
    _, fitted, _ = trained
    table = forecasting.feature_importances(spark, fitted)
    assert table.count() == 65
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert forecasting.top_features(table, 15).count() == 15


def test_command_line(spark, tmp_path, monkeypatch):
    settings = Settings()
    sinks.write_panel_csv(daily_wave(spark, 1000), f"{tmp_path}/loads.csv", SIX, settings)
    monkeypatch.setenv("LOADWEAVE_DATA_PATH", f"{tmp_path}/loads.csv")
    monkeypatch.setenv("LOADWEAVE_MODEL_PATH", f"{tmp_path}/model")
    monkeypatch.setenv("LOADWEAVE_TREES", "3")
    monkeypatch.setenv("LOADWEAVE_TREE_DEPTH", "2")
    monkeypatch.setenv("LOADWEAVE_TRAIN_RATIO", "0.7")
    out = f"{tmp_path}/out"
    for command in ("quality", "train", "evaluate", "stream"):
        assert main([command, "--out", out]) == 0
    report = spark.read.json(f"{out}/training_report").first()
    assert report.n_features == 65 and len(report.fold_results) == 4
    assert len(report.baseline_results) == 3
    score = spark.read.json(f"{out}/evaluation_report").first()
    assert score.evaluation_set_rows == 300 - 169
    assert isinstance(score.model_beats_all_baselines, bool)
    stream = spark.read.json(f"{out}/stream_report").first()
    assert stream.events_processed == 300 - 169
    assert stream.load_mae == pytest.approx(score.load.mae)
    messages = spark.read.json(f"{out}/metrics_messages").collect()
    assert len(messages) == (300 - 169) // 24
    assert messages[0].panel_id == "all"
    first = json.loads(messages[0].message)
    assert "latency_p99_ms" in first and first["total_events"] == 300 - 169


def test_boosting_stops_while_it_fits_and_scores_as_its_trees(spark, trained):
    """Fitting ends ``patience`` trees after the best one; the saved expression adds up the
    shrunk trees from the mean on."""
    panel, fitted, _ = trained
    noise = F.pmod(F.xxhash64("ts"), F.lit(1000)) - 500.0
    target = (F.col("pjme") + noise).alias("target")
    rows = panel.limit(300).select(target, "ts", *SIX.zones).cache()
    rows = forecasting.assembler(SIX.zones).transform(rows)
    held_out = (F.pmod(F.xxhash64("ts", F.lit(1)), F.lit(3)) == 0).alias("held_out")
    part = rows.select("features", "target", held_out)
    found = forecasting.boost(part, Settings(tree_depth=5), rounds=60, patience=4)
    assert len(found.errors) < 60  # not the cap
    assert len(found.trees) == forecasting.best_iteration(found.errors, 4) == len(found.errors) - 4
    mean = part.filter("not held_out").agg(F.avg("target")).first()[0]
    assert found.base == pytest.approx(mean)
    small = forecasting.Boosted(found.base, 0.1, found.trees[:3], ())
    scored = forecasting.as_model(small, list(SIX.zones)).transform(rows).select("features", "prediction")
    for r in scored.limit(20).collect():
        want = found.base + 0.1 * sum(t.predict(r.features) for t in found.trees[:3])
        assert r.prediction == pytest.approx(want, rel=1e-12)
    assert sum(found.importances) == pytest.approx(1.0)


def test_the_fold_error_is_that_of_its_best_round(trained):
    _, fitted, _ = trained
    for r in fitted.folds.collect():
        assert 0 < r.val_mae <= r.val_rmse
