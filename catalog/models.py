"""Queries that fit or use a model. A model is fitted once per session and data folder."""

from __future__ import annotations

from dataclasses import replace

from catalog import fixtures as X
from catalog.batch import Query
from catalog.fixtures import DAILY, r6
from loadweave.functions.expressions import price
from loadweave.operators import evaluation, forecasting, requests
from loadweave.session import scratch_path
from loadweave.settings import Settings
from loadweave.sources import sinks
from pyspark.sql import functions as F

SETTINGS = Settings()
QUERIES: dict[str, Query] = {}
FEW_TREES = replace(SETTINGS, trees=4)
_FITTED: dict[tuple[str, ...], tuple] = {}
_PANELS: dict[tuple[str, ...], tuple] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _panel_daily(spark, sf):
    """The daily panel, one row a day, and its number of rows: the table is read for it once per
    session and data folder, not again for the fit, the scores and the held-out rows."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PANELS:
        panel, steps = X.panel_daily(spark, sf)
        path = scratch_path(spark, "daily-panel")
        panel.write.parquet(path)
        _PANELS[key] = (spark.read.schema(panel.schema).parquet(path), steps)
    return _PANELS[key]


def fitted(spark, sf):
    """(trained, baseline scores, path of the saved model)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        panel, steps = _panel_daily(spark, sf)
        trained, baselines = forecasting.train(panel, DAILY, SETTINGS, steps)
        path = scratch_path(spark, "load-model")
        sinks.save_model(trained.model, path)
        _FITTED[key] = (trained, baselines, path)
    return _FITTED[key]


def fitted_suppliers(spark, sf):
    """(trained, baseline scores, path of the saved model) over the panels of all suppliers: rows
    grow with the data, trees are few."""
    key = (spark.sparkContext.applicationId, sf, "suppliers")
    if key not in _FITTED:
        panel, steps = X.panel_supplier(spark, sf)
        trained, baselines = forecasting.train(panel, DAILY, FEW_TREES, steps)
        path = scratch_path(spark, "load-model")
        sinks.save_model(trained.model, path)
        _FITTED[key] = (trained, baselines, path)
    return _FITTED[key]


def _forecast_suppliers(spark, sf):
    model = sinks.load_model(spark, fitted_suppliers(spark, sf)[2])
    panel, steps = X.panel_supplier(spark, sf)
    held = forecasting.holdout_features(panel, DAILY, SETTINGS, max_rows=steps)
    return forecasting.forecast(held, model, DAILY, SETTINGS, carry=("af_lag_1",)), steps


def _holdout(spark, sf):
    panel, steps = _panel_daily(spark, sf)
    return forecasting.holdout_features(panel, DAILY, SETTINGS, max_rows=steps), steps


def _forecast(spark, sf):
    model = sinks.load_model(spark, fitted(spark, sf)[2])
    held, steps = _holdout(spark, sf)
    return held, forecasting.forecast(held, model, DAILY, SETTINGS), steps


@query
def fold_metrics(spark, sf):
    return fitted(spark, sf)[0].folds


@query
def fold_sizes(spark, sf):
    return fitted(spark, sf)[0].folds.select("fold", "train_rows", "val_rows")


@query
def fold_sizes_suppliers(spark, sf):
    """Folds over the panels of all suppliers, cut by each panel's own rows."""
    return fitted_suppliers(spark, sf)[0].folds.select("fold", "train_rows", "val_rows")


@query
def top_features(spark, sf):
    return forecasting.top_features(forecasting.feature_importances(spark, fitted(spark, sf)[0]))


@query
def training_report(spark, sf):
    trained, baselines, path = fitted(spark, sf)
    target = scratch_path(spark, "training-report")
    sinks.write_report(forecasting.training_report(spark, trained, baselines, path), target)
    return spark.read.json(target)


@query
def forecast(spark, sf):
    return _forecast(spark, sf)[1]


def checked(results):
    """What of a forecast does not hang on the fit: the rows, what happened, and whether the
    price is the curve's at the forecast load and no load is negative."""
    load, cost = F.col("load_forecast_mw"), F.col("price_forecast_usd_mwh")
    return r6(
        results.select(
            "panel_id",
            "ts",
            "sequence_id",
            "load_actual_mw",
            "price_actual_usd_mwh",
            (F.abs(cost - price(load)) < 1e-6).alias("price_on_curve"),
            (load >= 0).alias("not_negative"),
        )
    )


@query
def forecast_rows(spark, sf):
    return checked(_forecast(spark, sf)[1])


@query
def forecast_rows_suppliers(spark, sf):
    """Forecasts of every supplier's held-out rows by one model of all suppliers."""
    return checked(_forecast_suppliers(spark, sf)[0].drop("af_lag_1"))


@query
def model_beats_all(spark, sf):
    held, results, steps = _forecast(spark, sf)
    errors = evaluation.error_table(
        results, ["panel_id"], "load_actual_mw", "load_forecast_mw"
    )
    baselines = evaluation.evaluate_baselines(
        held, ["panel_id"], ["ts"], "target", "af_lag_1", max_rows=steps
    )
    return evaluation.beats_all(errors, baselines, ["panel_id"])


def _report(spark, sf):
    model = sinks.load_model(spark, fitted(spark, sf)[2])
    held, steps = _holdout(spark, sf)
    results = forecasting.forecast(held, model, DAILY, SETTINGS, carry=("af_lag_1",))
    return forecasting.evaluation_report(results, DAILY, "af_lag_1", steps)


@query
def evaluation_report(spark, sf):
    target = scratch_path(spark, "evaluation-report")
    sinks.write_report(_report(spark, sf), target)
    return spark.read.json(target)


@query
def evaluation_baselines(spark, sf):
    """What of the report does not hang on the fit: rows, and the scores of the baselines."""
    report = evaluation_report(spark, sf)
    scores = report.select("evaluation_set_rows", F.inline("baseline_results"))
    return r6(scores)


@query
def evaluation_baselines_suppliers(spark, sf):
    """One report over the held-out rows of all suppliers: rows, and the scores of the baselines."""
    results, steps = _forecast_suppliers(spark, sf)
    target = scratch_path(spark, "evaluation-report")
    sinks.write_report(forecasting.evaluation_report(results, DAILY, "af_lag_1", steps), target)
    report = spark.read.json(target)
    return r6(report.select("evaluation_set_rows", F.inline("baseline_results")))


@query
def training_checks(spark, sf):
    """What of a training report, read back, does not hang on the fit."""
    report = training_report(spark, sf)
    gains = F.map_values(F.from_json(F.to_json("feature_importances"), "map<string,double>"))
    total = F.aggregate(gains, F.lit(0.0), lambda a, b: a + b)
    return r6(
        report.select(
            "n_training_rows",
            "n_features",
            F.array_join(F.sort_array("feature_names"), ",").alias("feature_names"),
            F.size("fold_results").cast("long").alias("n_folds"),
            F.size("baseline_results").cast("long").alias("n_baselines"),
            F.size(gains).cast("long").alias("n_importances"),
            total.alias("sum_importances"),
        )
    )


@query
def model_reload(spark, sf):
    """A saved model scores every held-out row as the fitted one does."""
    trained, _, path = fitted(spark, sf)
    held, _ = _holdout(spark, sf)
    again = sinks.load_model(spark, path)
    ours = forecasting.score(held, trained.model).select("panel_id", "ts", "prediction")
    theirs = forecasting.score(held, again).select("panel_id", "ts", F.col("prediction").alias("again"))
    joined = ours.join(theirs, ["panel_id", "ts"])
    return joined.select("panel_id", "ts", (F.col("prediction") == F.col("again")).alias("same_score"))


@query
def clipped_forecast(spark, sf):
    """A forecast that is often negative, for every supplier: no load is, and the price follows."""
    events, _ = X.events_supplier(spark, sf)
    made = evaluation.two_stage(events, F.col("ao") - F.lit(20.0), F.col("af"), F.col("sequence_id"))
    return r6(made.drop("latency_ns"))


@query
def request_answers(spark, sf):
    load, cost = F.col("load_forecast_mw"), F.col("price_forecast_usd_mwh")
    return request_forecast(spark, sf).select(
        "request_id",
        "timestamp_predicted",
        (load == F.bround(load, 1)).alias("load_rounded"),
        (cost == F.bround(cost, 2)).alias("price_rounded"),
        "model_version",
    )


@query
def request_forecast(spark, sf):
    path = fitted(spark, sf)[2]
    model = sinks.load_model(spark, path)
    rows = requests.request_features(X.requests(spark, sf), DAILY, SETTINGS)
    scored = forecasting.score(rows, model)
    clipped = scored.withColumn("prediction", F.greatest("prediction", F.lit(0.0)))
    return requests.answer_requests(clipped, DAILY, "prediction", "load_model", SETTINGS)


@query
def request_answers_suppliers(spark, sf):
    """Answers to every supplier's requests, on the features of training; no latency is measured."""
    model = sinks.load_model(spark, fitted_suppliers(spark, sf)[2])
    rows = requests.request_features(X.requests_supplier(spark, sf), DAILY, SETTINGS, "parity")
    scored = forecasting.score(rows, model)
    clipped = scored.withColumn("prediction", F.greatest("prediction", F.lit(0.0)))
    answers = requests.answer_requests(clipped, DAILY, "prediction", "load_model", SETTINGS)
    load, cost = F.col("load_forecast_mw"), F.col("price_forecast_usd_mwh")
    return answers.select(
        "request_id",
        "timestamp_predicted",
        (load == F.bround(load, 1)).alias("load_rounded"),
        (cost == F.bround(cost, 2)).alias("price_rounded"),
        "inference_latency_ms",
        "model_version",
    )
