"""Batch queries: one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as X
from catalog.fixtures import DAILY, HOURLY, r6, r9
from loadweave.functions import expressions as E
from loadweave.functions.metrics import LATENCY_NAMES
from loadweave.operators import cleaning, evaluation, features, quality, release, requests, splits
from loadweave.operators.baselines import BASELINES, baseline_columns
from loadweave.plans.layout import lay_out
from loadweave.plans.windows import WindowColumns
from loadweave.session import scratch_path
from loadweave.settings import Settings
from loadweave.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
SETTINGS = Settings()
CSV = Settings(datetime_col="Datetime", target_zone="AF", other_zones=("AO", "NF", "NO", "RF", "RO"))
EVENT_ORDER = ("ts", "event_id")

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Sources and sinks


@query
def csv_roundtrip(spark, sf):
    panel, _ = X.panel_daily(spark, sf)
    path = scratch_path(spark, "panel-csv")
    sinks.write_panel_csv(panel, path, DAILY, CSV)
    return r6(readers.read_panel_csv(spark, path, CSV).drop("ingest_seq"))


@query
def csv_dirty(spark, sf):
    """Two sets of files with faults, the second in another column order with one column more
    and NaN for missing values, read by name and cleaned."""
    dirty = X.raw_dirty(spark, sf)[0]
    path = scratch_path(spark, "dirty-csv")
    first, again = (dirty.filter(F.col("ingest_seq") % 10 == copy) for copy in (0, 1))
    sinks.write_panel_csv(first, f"{path}/a", DAILY, CSV)
    names = dict(zip(DAILY.zones, CSV.zones))
    again.select(
        *[F.col(z).alias(names[z]) for z in reversed(DAILY.zones)],
        F.lit("x, y").alias("note"),
        F.date_format("ts", sinks.TS_FORMAT).alias(CSV.datetime_col),
    ).write.option("header", True).option("nullValue", "NaN").csv(f"{path}/b")
    return r6(cleaning.clean(readers.read_panel_csv(spark, f"{path}/*", CSV), DAILY))


@query
def select_required(spark, sf):
    wide = X.panel_daily_sparse(spark, sf).withColumn("unused", F.lit(1))
    return readers.select_required(wide, ["panel_id", "ts", *DAILY.zones])


@query
def panel_daily(spark, sf):
    return r6(X.panel_daily(spark, sf)[0])


@query
def panel_hourly(spark, sf):
    return r6(X.panel_hourly_sparse(spark, sf))


@query
def regularized_hourly(spark, sf):
    return r6(readers.regularize(X.panel_hourly_sparse(spark, sf), HOURLY, "hour"))


@query
def forecast_messages(spark, sf):
    errors = evaluation.forecast_errors(r6(_results(spark, sf)[0]))
    parsed = sinks.parse_messages(sinks.forecast_messages(errors), sinks.FORECAST_SCHEMA)
    return r6(parsed)


@query
def metrics_messages(spark, sf):
    results, steps = _results(spark, sf)
    shots = evaluation.cumulative_snapshots(results, max_rows=steps)
    parsed = sinks.parse_messages(sinks.metrics_messages(shots), sinks.METRICS_SCHEMA)
    return r6(parsed)


# Projections and filters


@query
def drop_incomplete(spark, sf):
    return cleaning.drop_incomplete(X.panel_daily_sparse(spark, sf), DAILY.zones)


@query
def clip_negative(spark, sf):
    dirty = X.raw_dirty(spark, sf)[0]
    kept = cleaning.drop_incomplete(dirty, DAILY.zones)
    return cleaning.clip_negative(kept, DAILY.zones)


@query
def price_curve(spark, sf):
    series, _ = X.series_supplier(spark, sf)
    return r6(series.withColumn("price", E.price(F.col("v"))))


@query
def price_actual(spark, sf):
    lineitem = readers.read_table(spark, sf, "lineitem")
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return r6(
        lineitem.select(
            key.alias("sequence_id"),
            "l_quantity",
            E.price_actual(F.col("l_quantity"), key).alias("price_actual"),
        )
    )


@query
def calendar_features(spark, sf):
    events = readers.read_table(spark, sf, "events")
    names = ("hour_of_day", "day_of_week", "month", "day_of_year", "is_weekend")
    cal = E.calendar(F.col("ts"))
    return events.select("event_id", *[cal[n].alias(n) for n in names])


@query
def cyclic_features(spark, sf):
    events = readers.read_table(spark, sf, "events")
    cal = E.calendar(F.col("ts"))
    names = [n for n in cal if n.endswith(("_sin", "_cos"))]
    return r6(events.select("event_id", *[cal[n].alias(n) for n in names]))


def _made(layout, columns, make):
    """``columns`` of the layout's rows and the window columns ``make`` defines."""
    w = WindowColumns(layout.window)
    cols = make(w)
    rows = layout.core(w.onto(layout.df))
    return r6(rows.select(*columns, *[c.alias(n) for n, c in cols.items()]))


def _on_series(spark, sf, back, make):
    """Window columns of the supplier series."""
    series, steps = X.series_supplier(spark, sf)
    layout = lay_out(series, ["panel_id"], ["ts"], back=back, max_rows=steps)
    return _made(layout, ["panel_id", "ts", "v"], make)


def _on_panel(spark, sf, make):
    """Window columns of the dense daily panel."""
    panel, steps = X.panel_daily(spark, sf)
    layout = features.panel_layout(panel, DAILY, max_rows=steps)
    return _made(layout, ["panel_id", "ts"], make)


@query
def diff_features(spark, sf):
    return _on_series(spark, sf, 24, lambda w: features.diffs("v", w))


@query
def ratio_features(spark, sf):
    return _on_panel(spark, sf, lambda w: features.ratios(DAILY, w, "ieee"))


@query
def ratio_fallback(spark, sf):
    return _on_panel(spark, sf, lambda w: features.ratios(DAILY, w, "fallback"))


@query
def ratio_null(spark, sf):
    return _on_panel(spark, sf, lambda w: features.ratios(DAILY, w, "null"))


def _results(spark, sf):
    """Two-stage results of the persistence forecast on the daily panel."""
    return _persistence(*X.indexed_daily(spark, sf))


def _persistence(events, steps):
    layout = lay_out(events, ["panel_id"], ["ts"], back=1, max_rows=steps)
    made = layout.core(layout.df.withColumn("_p", F.lag("af", 1).over(layout.window)))
    results = evaluation.two_stage(
        made.filter(F.col("_p").isNotNull()),
        F.col("_p"),
        F.col("af"),
        F.col("sequence_id"),
        X.latency_stand_in(F.col("sequence_id")),
    )
    return results, steps


@query
def two_stage(spark, sf):
    return r6(_results(spark, sf)[0])


@query
def forecast_errors(spark, sf):
    errors = evaluation.forecast_errors(_results(spark, sf)[0])
    return r6(
        errors.select(
            "sequence_id", "load_error_mw", "price_error_usd_mwh", "inference_latency_ms"
        )
    )


@query
def present_forecast(spark, sf):
    events = readers.read_table(spark, sf, "events")
    shown = E.present(F.col("value"), F.col("event_id") * 7919)
    return events.select("event_id", *[c.alias(n) for n, c in shown.items()])


# Ordering, dedup, limits


@query
def dedup_last(spark, sf):
    lineitem = readers.read_table(spark, sf, "lineitem")
    return cleaning.dedup_last(
        lineitem.select(
            "l_suppkey",
            "l_shipdate",
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_seq"),
            "l_quantity",
            F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")).alias("l_extendedprice"),
        ),
        ["l_suppkey", "l_shipdate"],
        "ingest_seq",
    )


def _event_log(spark, sf):
    return readers.read_table(spark, sf, "events").withColumn("panel_id", F.lit("all"))


@query
def row_index(spark, sf):
    events = _event_log(spark, sf).select("panel_id", "ts", "event_id")
    return splits.row_index(events, ["panel_id"], EVENT_ORDER)


@query
def row_index_chunked(spark, sf):
    """The plan for long groups: about 16 chunks at any size."""
    events = _event_log(spark, sf).select("panel_id", "ts", "event_id")
    return splits.row_index(events, ["panel_id"], EVENT_ORDER, rows_per_chunk=_sixteenth(events))


def _sixteenth(df):
    return max(16, df.count() // 16)


@query
def chrono_split(spark, sf):
    events = _event_log(spark, sf).select("panel_id", "ts", "event_id")
    return splits.chrono_split(events, ["panel_id"], EVENT_ORDER, 0.8)


@query
def walk_forward_folds(spark, sf):
    events = _event_log(spark, sf).select("panel_id", "ts", "event_id")
    return splits.walk_forward_folds(events, ["panel_id"], EVENT_ORDER, 5)


@query
def folds_embargo(spark, sf):
    events = _event_log(spark, sf).select("panel_id", "ts", "event_id")
    return splits.walk_forward_folds(events, ["panel_id"], EVENT_ORDER, 5, embargo=168)


@query
def latest_points(spark, sf):
    events = readers.read_table(spark, sf, "events")
    points = events.select("event_type", "ts", "event_id", "value")
    return evaluation.latest(points, ["event_type"], EVENT_ORDER, 200)


@query
def first_points(spark, sf):
    events = readers.read_table(spark, sf, "events")
    return events.orderBy(*EVENT_ORDER).limit(120).select("event_id", "ts", "value")


# Quality


@query
def outlier_flags(spark, sf):
    panel, _ = _clean(spark, sf)
    return r6(quality.outlier_flags(panel, DAILY, n_panels=1))


@query
def outlier_report(spark, sf):
    panel, _ = _clean(spark, sf)
    return r6(quality.outlier_report(panel, DAILY, n_panels=1))


def _clean(spark, sf):
    dirty, steps = X.raw_dirty(spark, sf)
    return cleaning.clean(dirty, DAILY), steps


@query
def clean_panel(spark, sf):
    return r6(_clean(spark, sf)[0])


@query
def gap_report(spark, sf):
    panel, steps = _clean(spark, sf)
    return quality.gap_report(panel, DAILY, step_hours=24.0, max_rows=steps)


@query
def gap_report_hourly(spark, sf):
    return quality.gap_report(X.panel_hourly_sparse(spark, sf), HOURLY)


@query
def panel_summary(spark, sf):
    series, _ = X.series_supplier(spark, sf)
    return quality.panel_summary(series, DAILY)


@query
def quality_counts(spark, sf):
    return quality.quality_counts(X.raw_dirty(spark, sf)[0], DAILY)


# Windows


@query
def target_lags(spark, sf):
    return _on_series(
        spark, sf, 168, lambda w: features.lags("v", SETTINGS.target_lags, w)
    )


@query
def cross_lags(spark, sf):
    def make(w):
        cols = {}
        for z in DAILY.others:
            cols |= features.lags(z, SETTINGS.cross_lags, w)
        return cols

    return _on_panel(spark, sf, make)


def _rolling(spark, sf, stats, windows):
    def make(w):
        cols = {}
        for n in windows:
            cols |= features.trailing("v", n, w, stats)
        return cols

    return _on_series(spark, sf, max(windows), make)


@query
def rolling_mean(spark, sf):
    return _rolling(spark, sf, ("mean",), SETTINGS.target_windows)


@query
def rolling_std(spark, sf):
    return _rolling(spark, sf, ("std",), SETTINGS.target_windows)


@query
def rolling_minmax(spark, sf):
    return _rolling(spark, sf, ("min", "max"), (24,))


@query
def cross_rolling(spark, sf):
    def make(w):
        cols = {}
        for z in DAILY.others:
            cols |= features.trailing(z, 24, w, ("mean",))
        return cols

    return _on_panel(spark, sf, make)


def _features(spark, sf, policy="fallback", **more):
    panel, steps = X.panel_daily(spark, sf)
    return features.build_features(panel, DAILY, policy=policy, max_rows=steps, **more), steps


@query
def feature_matrix(spark, sf):
    return r6(_features(spark, sf)[0])


@query
def feature_matrix_ieee(spark, sf):
    return r6(_features(spark, sf, "ieee")[0])


@query
def feature_matrix_suppliers(spark, sf):
    """All features of every supplier's panel: rows grow with the data."""
    panel, steps = X.panel_supplier(spark, sf)
    return r6(features.build_features(panel, DAILY, policy="fallback", max_rows=steps))


@query
def feature_interval(spark, sf):
    """The features of one quarter of every supplier, from its rows and what they reach back to."""
    panel, steps = X.panel_supplier(spark, sf)
    made = features.build_interval(
        panel, DAILY, "1997-04-01 00:00:00", "1997-06-30 00:00:00", policy="fallback", max_rows=steps
    )
    return r6(made)


@query
def feature_matrix_chunked(spark, sf):
    panel, _ = X.panel_daily(spark, sf)
    return r6(features.build_features(panel, DAILY, policy="fallback", rows_per_chunk=400))


@query
def features_online_compat(spark, sf):
    panel, steps = X.panel_daily(spark, sf)
    return r6(features.build_features_online_compat(panel, DAILY, max_rows=steps))


def _baseline(spark, sf, name):
    return _on_series(
        spark, sf, 168, lambda w: {name: baseline_columns("v", w)[name]}
    )


@query
def baseline_naive(spark, sf):
    return _baseline(spark, sf, BASELINES[0])


@query
def baseline_seasonal(spark, sf):
    return _baseline(spark, sf, BASELINES[1])


@query
def baseline_ma24(spark, sf):
    return _baseline(spark, sf, BASELINES[2])


# Aggregations


@query
def metrics_by_panel(spark, sf):
    series, steps = X.series_supplier(spark, sf)
    layout = lay_out(series, ["panel_id"], ["ts"], back=1, max_rows=steps)
    rows = layout.core(layout.df.withColumn("p", F.lag("v", 1).over(layout.window)))
    return r6(evaluation.error_table(rows, ["panel_id"], "v", "p"))


@query
def mape_edges(spark, sf):
    events = readers.read_table(spark, sf, "events").withColumn(
        "edge", F.explode(F.array(*[F.lit(e) for e in ("mixed", "zeros", "empty", "negative")]))
    )
    edge, v = F.col("edge"), F.col("value")
    actual = (
        F.when(edge == "mixed", F.when(F.col("event_id") % 2 == 0, v).otherwise(F.lit(0.0)))
        .when(edge == "zeros", F.lit(0.0))
        .when(edge == "negative", -v)
    )
    rows = events.select("edge", "event_type", actual.alias("a"), (v + 1).alias("p"))
    return r6(evaluation.error_table(rows, ["edge", "event_type"], "a", "p"))


@query
def latency_percentiles(spark, sf):
    events = readers.read_table(spark, sf, "events").select(
        "event_type", F.round(F.col("value") * 10000).cast("long").alias("latency_ns")
    )
    return r6(evaluation.exact_percentiles(events, ["event_type"], "latency_ns"))


@query
def fold_averages(spark, sf):
    return r6(evaluation.fold_averages(_persistence_folds(spark, sf)))


def _persistence_folds(spark, sf):
    """Validation errors of persistence on the walk-forward folds."""
    results, steps = _results(spark, sf)
    folds = splits.walk_forward_folds(
        results, ["panel_id"], ["sequence_id"], 5, max_rows=steps
    ).filter(F.col("role") == "validate")
    table = evaluation.error_table(folds, ["fold"], "load_actual_mw", "load_forecast_mw")
    return table.select(
        "fold",
        F.col("n_samples").alias("val_rows"),
        (F.col("n_samples") % 37 + F.col("fold")).alias("best_iteration"),
        F.col("mae").alias("val_mae"),
        F.col("rmse").alias("val_rmse"),
        F.col("mape").alias("val_mape"),
    )


@query
def persistence_folds(spark, sf):
    return r6(_persistence_folds(spark, sf))


def _baseline_eval(spark, sf, series, convention):
    rows, steps = _features(spark, sf, keep=("af",))
    return r6(
        evaluation.evaluate_baselines(
            rows, ["panel_id"], ["ts"], "target", series, convention, max_rows=steps
        )
    )


@query
def baseline_eval(spark, sf):
    return _baseline_eval(spark, sf, "af_lag_1", "shifted")


@query
def baseline_eval_current(spark, sf):
    return _baseline_eval(spark, sf, "af", "current")


@query
def current_beats_all(spark, sf):
    """Whether the value of the row itself, as a forecast, beats all shifted baselines."""
    rows, steps = _features(spark, sf, keep=("af",))
    ours = evaluation.error_table(rows, ["panel_id"], "target", "af")
    baselines = evaluation.evaluate_baselines(
        rows, ["panel_id"], ["ts"], "target", "af_lag_1", max_rows=steps
    )
    return r6(evaluation.beats_all(ours, baselines, ["panel_id"]))


@query
def baseline_eval_suppliers(spark, sf):
    """The feature matrix of every supplier's panel, scored by the baselines."""
    panel, steps = X.panel_supplier(spark, sf)
    rows = features.build_features(panel, DAILY, max_rows=steps)
    return r6(
        evaluation.evaluate_baselines(
            rows, ["panel_id"], ["ts"], "target", "af_lag_1", max_rows=steps
        )
    )


@query
def metric_snapshots(spark, sf):
    results, steps = _results(spark, sf)
    return r6(evaluation.cumulative_snapshots(results, max_rows=steps))


@query
def metric_snapshots_chunked(spark, sf):
    return r6(evaluation.cumulative_snapshots(_results(spark, sf)[0], rows_per_chunk=30))


@query
def snapshot_latency(spark, sf):
    results, steps = _results(spark, sf)
    shots = evaluation.cumulative_snapshots(results, latency=True, max_rows=steps)
    return _unnested(evaluation.metrics_message_struct(shots))


@query
def snapshot_latency_suppliers(spark, sf):
    results, steps = _persistence(*X.events_supplier(spark, sf))
    return r9(evaluation.cumulative_snapshots(results, latency=True, max_rows=steps), LATENCY_NAMES)


def _unnested(shots):
    """The nested snapshot as plain columns."""
    errors = [
        F.col(f"{kind}_metrics.{m}").alias(f"{kind}_{m}")
        for kind in ("load", "price")
        for m in ("mae", "rmse", "mape")
    ]
    shown = shots.select("panel_id", "snapshot", "events_processed", *errors, "latency.*")
    return r9(shown, LATENCY_NAMES)


@query
def rolling_metrics(spark, sf):
    results, steps = _results(spark, sf)
    return r6(evaluation.rolling_metrics(results, max_rows=steps))


@query
def final_metrics(spark, sf):
    return r6(evaluation.final_metrics(_results(spark, sf)[0]))


@query
def error_histogram(spark, sf):
    return r6(evaluation.error_histogram(evaluation.forecast_errors(_results(spark, sf)[0])))


@query
def replay_status(spark, sf):
    events = readers.read_table(spark, sf, "events")
    as_of = F.lit("2024-01-12 12:00:00").cast("timestamp_ntz")
    return evaluation.replay_status(events, as_of, ["user_id"])


@query
def release_schedule(spark, sf):
    events = readers.read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    return r6(
        release.release_schedule(
            events, ["user_id"], "ts", "event_id", capacity=3.0, rate=1.0 / 21600.0
        )
    )


@query
def release_schedule_chunked(spark, sf):
    events = readers.read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    made = release.release_schedule(
        events, ["user_id"], "ts", "event_id", capacity=3.0, rate=1.0 / 21600.0, rows_per_chunk=8
    )
    return r6(made)


@query
def release_schedule_cost(spark, sf):
    events = readers.read_table(spark, sf, "events").select(
        "event_id", "user_id", "ts", (F.col("event_id") % 3 + 1).cast("double").alias("cost")
    )
    return r6(
        release.release_schedule(
            events, ["user_id"], "ts", "event_id", capacity=4.0, rate=1.0 / 7200.0, cost="cost"
        )
    )


# Requests


@query
def request_validation(spark, sf):
    rows = requests.validate_requests(X.requests(spark, sf), DAILY)
    return rows.select("request_id", "ts", F.col("n_values").cast("long").alias("n_values"), "status", "reason")


@query
def request_rows(spark, sf):
    return requests.expand_requests(X.requests(spark, sf), DAILY)


@query
def request_features(spark, sf):
    return r6(requests.request_features(X.requests(spark, sf), DAILY))


@query
def request_validation_suppliers(spark, sf):
    """Requests of every supplier for the features of training, which need one value more."""
    rows = requests.validate_requests(X.requests_supplier(spark, sf), DAILY, convention="parity")
    return rows.select("request_id", "ts", F.col("n_values").cast("long").alias("n_values"), "status", "reason")


@query
def request_features_parity(spark, sf):
    """The answers of every supplier's requests rest on the very features of the batch matrix."""
    return r6(requests.request_features(X.requests_supplier(spark, sf), DAILY, convention="parity"))
