import math

import pytest
from pyspark.sql import functions as F

from loadweave.functions.expressions import present, price, price_actual
from loadweave.operators import cleaning, evaluation, quality, release, requests, splits
from loadweave.operators.features import build_features, build_features_online_compat
from loadweave.session import scratch_path
from loadweave.settings import Settings
from loadweave.sources import readers, sinks
from tests.helpers import RAMP, SIX, hourly, noisy, ramp, same

ONE = readers.PanelSpec(target="v", others=("u",))


def panel(spark, rows):
    """(panel, hour, seq, v, u) rows."""
    df = spark.createDataFrame(rows, "panel_id string, h int, ingest_seq long, v double, u double")
    first = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return df.select(
        "panel_id", "ingest_seq", F.timestamp_add("HOUR", F.col("h"), first).alias("ts"), "v", "u"
    )


# Cleaning and quality


def test_clean_order(spark):
    """Keep-last comes before the null drop: hour 1 is lost, hour 2 clipped."""
    raw = panel(
        spark,
        [
            ("p", 0, 1, 1.0, 1.0),
            ("p", 0, 2, 2.0, 1.0),
            ("p", 1, 3, 5.0, 1.0),
            ("p", 1, 4, None, 1.0),
            ("p", 2, 5, -3.0, 1.0),
        ],
    )
    rows = cleaning.clean(raw, ONE).orderBy("ts").collect()
    assert [(r.ts.hour, r.v) for r in rows] == [(0, 2.0), (2, 0.0)]
    counts = {
        (r.check, r.zone): r.n for r in quality.quality_counts(raw, ONE).collect()
    }
    assert counts == {
        ("duplicate_ts", "*"): 2,
        ("incomplete", "*"): 1,
        ("negative", "v"): 1,
        ("negative", "u"): 0,
    }


def test_dedup_is_idempotent(spark):
    raw = panel(spark, [("p", i % 5, i, float(i), 0.0) for i in range(23)])
    once = cleaning.dedup_last(raw, ["panel_id", "ts"], "ingest_seq")
    same(once, cleaning.dedup_last(once, ["panel_id", "ts"], "ingest_seq"))
    assert once.count() == 5


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="v2"):
        readers.select_required(panel(spark, []), ["ts", "v2"])


def test_gaps(spark):
    df = panel(spark, [("p", h, h, 1.0, 1.0) for h in (0, 1, 3, 4, 9)])
    row = quality.gap_report(df, ONE).first()
    assert (row.gaps, row.large_gaps, row.longest_gap_hours) == (2, 1, 5.0)


def test_outliers_are_strict_and_kept(spark):
    values = [1.0] * 60 + [1000.0]
    df = panel(spark, [("p", i, i, v, 1.0) for i, v in enumerate(values)])
    flagged = quality.outlier_flags(df, ONE)
    assert flagged.count() == 61
    assert flagged.filter("v_outlier").select("v").first().v == 1000.0
    assert flagged.filter("u_outlier").count() == 0  # equal to the limit, not above
    report = {r.zone: r.n_outliers for r in quality.outlier_report(df, ONE).collect()}
    assert report == {"v": 1, "u": 0}
    assert quality.outlier_flags(df.limit(1), ONE).first().v_outlier is False


# Sources and sinks


def test_csv(spark):
    settings = Settings()
    path = scratch_path(spark, "csv")
    loads = ramp(spark, 30)
    sinks.write_panel_csv(loads, path, SIX, settings)
    back = readers.read_panel_csv(spark, path, settings)
    assert back.columns == ["panel_id", "ingest_seq", "ts", *SIX.zones]
    same(
        back.drop("ingest_seq", "panel_id"), loads.drop("sequence_id", "panel_id")
    )
    assert cleaning.clean(back, SIX).count() == 30
    with pytest.raises(FileNotFoundError):
        readers.read_panel_csv(spark, path + "-absent", settings)
    with pytest.raises(ValueError, match="NOWHERE"):
        readers.read_panel_csv(spark, path, Settings(target_zone="NOWHERE"))


def test_model_must_exist(spark):
    with pytest.raises(FileNotFoundError):
        sinks.load_model(spark, scratch_path(spark, "no-model"))


def test_densify_and_regularize(spark):
    df = panel(spark, [("p", h, h, 1.0 + h, 2.0) for h in (2, 3, 6)])
    df = df.unionByName(panel(spark, [("q", 5, 0, 9.0, 9.0)]))
    first, steps = readers.span(df, "ts", "hour")
    assert steps == 5
    for chunk in (None, 1):
        dense = readers.densify(df, ONE, first, steps, "hour", rows_per_chunk=chunk)
        got = {(r.panel_id, r.ts.hour): r.v for r in dense.collect()}
        assert dense.count() == 10
        assert [got["p", h] for h in range(2, 7)] == [3.0, 4.0, 0.0, 0.0, 7.0]
        assert [got["q", h] for h in range(2, 7)] == [0.0, 0.0, 0.0, 9.0, 0.0]
    for chunk in (None, 1):
        whole = readers.regularize(df, ONE, rows_per_chunk=chunk)
        assert whole.count() == 6 and whole.filter("v is null").count() == 2
    twice = df.unionByName(panel(spark, [("q", 5, 1, 8.0, 8.0)]))
    assert readers.regularize(twice, ONE).count() == 7


def test_settings_from_env():
    made = Settings.from_env({"LOADWEAVE_TRAIN_RATIO": "0.7", "LOADWEAVE_CROSS_LAGS": "[1, 2]"})
    assert made.train_ratio == 0.7 and made.cross_lags == (1, 2)
    assert Settings.from_env({}) == Settings()
    assert Settings.zones.fget(Settings())[0] == "PJME"


# Price


@pytest.mark.parametrize(
    "load,expected", [(0, 15.0), (20000, 915.0), (30000, 1965.0), (40000, 3415.0), (50000, 5265.0)]
)
def test_price_points(spark, load, expected):
    df = spark.createDataFrame([(float(load),)], "l double")
    assert df.select(price(F.col("l"))).first()[0] == pytest.approx(expected, abs=1e-9)


def test_noise_is_normal_and_belongs_to_the_row(spark):
    df = spark.range(20000).select("id", F.lit(30000.0).alias("l"))
    noise = df.select("id", (price_actual(F.col("l"), F.col("id")) - price(F.col("l"))).alias("e"))
    mean, sd = noise.agg(F.avg("e"), F.stddev("e")).first()
    assert abs(mean) < 0.1 and abs(sd - 2.0) < 0.1
    same(noise, noise.repartition(7), 12)


def test_present_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.25,), (0.35,)], "l double")
    shown = present(F.col("l"), F.lit(1_234_567))
    rows = df.select(*[c.alias(n) for n, c in shown.items()]).collect()
    assert [r.load_forecast_mw for r in rows] == [0.2, 0.4]
    assert rows[0].inference_latency_ms == 1.23


# Splits


@pytest.mark.parametrize("chunk", [None, 32])
def test_split_and_folds(spark, chunk):
    df = hourly(spark, 103).unionByName(hourly(spark, 11, panel="q"))
    parts = splits.chrono_split(df, ["panel_id"], ["ts"], 0.8, rows_per_chunk=chunk)
    sizes = {
        (r.panel_id, r.split): (r.n, r.top)
        for r in parts.groupBy("panel_id", "split")
        .agg(F.count("*").alias("n"), F.max("split_index").alias("top"))
        .collect()
    }
    assert sizes == {
        ("p", "train"): (82, 81),
        ("p", "stream"): (21, 20),
        ("q", "train"): (8, 7),
        ("q", "stream"): (3, 2),
    }
    folds = splits.walk_forward_folds(df, ["panel_id"], ["ts"], 5, rows_per_chunk=chunk)
    spans = {
        (r.fold, r.role): (r.a, r.b, r.n)
        for r in folds.filter("panel_id = 'p'")
        .groupBy("fold", "role")
        .agg(F.min("row_index").alias("a"), F.max("row_index").alias("b"), F.count("*").alias("n"))
        .collect()
    }
    assert spans[1, "train"] == (0, 19, 20) and spans[1, "validate"] == (20, 39, 20)
    assert spans[4, "train"] == (0, 79, 80) and spans[4, "validate"] == (80, 102, 23)
    held = splits.walk_forward_folds(df, ["panel_id"], ["ts"], 5, embargo=7, rows_per_chunk=chunk)
    last = held.filter("fold = 2 and role = 'train' and panel_id = 'p'").agg(F.max("row_index"))
    assert last.first()[0] == 32


# Metrics


def test_metric_edges(spark):
    rows = [("n", 2.0, 1.0), ("n", 0.0, 5.0), ("n", -4.0, -2.0), ("z", 0.0, 1.0), ("e", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, a double, p double")
    got = {r.k: r for r in evaluation.error_table(df, ["k"], "a", "p").collect()}
    assert got["n"].mae == pytest.approx(8 / 3) and got["n"].rmse == pytest.approx(math.sqrt(10))
    assert got["n"].mape == pytest.approx(50.0)
    assert (got["z"].mae, got["z"].mape) == (1.0, math.inf)
    assert (got["e"].mae, got["e"].rmse, got["e"].mape, got["e"].n_samples) == (0.0, 0.0, 0.0, 0)
    empty = evaluation.error_table(df.filter("false"), [], "a", "p").first()
    assert (empty.mae, empty.rmse, empty.mape) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("chunk", [None, 10])
def test_percentiles(spark, chunk):
    import numpy as np

    values = [(i * 7919) % 1013 for i in range(500)]
    df = spark.createDataFrame([("k", v * 1_000_000) for v in values], "k string, x long")
    row = evaluation.exact_percentiles(df, ["k"], "x", rows_per_chunk=chunk).first()
    want = np.percentile(np.array(values, dtype=float), [50, 95, 99])
    assert [row.p50_ms, row.p95_ms, row.p99_ms] == pytest.approx(list(want))


def results(spark, n):
    return hourly(spark, n).select(
        "panel_id",
        "ts",
        "sequence_id",
        (F.col("sequence_id") * 37 % 101).cast("double").alias("load_actual_mw"),
        (F.col("sequence_id") * 53 % 97).cast("double").alias("load_forecast_mw"),
        (F.col("sequence_id") % 13).cast("double").alias("price_actual_usd_mwh"),
        (F.col("sequence_id") % 11).cast("double").alias("price_forecast_usd_mwh"),
        (F.col("sequence_id") * 1000).alias("latency_ns"),
    )


def test_snapshots(spark):
    rows = results(spark, 500)
    shots = evaluation.cumulative_snapshots(rows)
    assert shots.count() == 20 and shots.agg(F.max("events_processed")).first()[0] == 480
    same(shots, evaluation.cumulative_snapshots(rows, rows_per_chunk=8))
    last = shots.orderBy(F.desc("snapshot")).first()
    direct = evaluation.final_metrics(rows.filter("sequence_id < 480")).first()
    for name in ("load_mae", "load_rmse", "load_mape", "price_mae", "price_rmse", "price_mape"):
        assert last[name] == pytest.approx(direct[name])
    assert evaluation.cumulative_snapshots(results(spark, 23)).count() == 0
    every5 = evaluation.cumulative_snapshots(results(spark, 5), every=5).first()
    assert every5.events_processed == 5


def test_rolling_metrics_chunks(spark):
    rows = results(spark, 300)
    rolled = evaluation.rolling_metrics(rows)
    assert rolled.count() == 277
    same(rolled, evaluation.rolling_metrics(rows, rows_per_chunk=50))


def test_baselines_chunks_and_conventions(spark):
    rows = noisy(spark, 600)
    args = (["panel_id"], ["ts"], "aep", "pjme")
    for convention in ("shifted", "current"):
        same(
            evaluation.evaluate_baselines(rows, *args, convention),
            evaluation.evaluate_baselines(rows, *args, convention, rows_per_chunk=200),
        )
    n = {r.baseline: r.n_samples for r in evaluation.evaluate_baselines(rows, *args).collect()}
    assert n == {"naive_persistence": 599, "seasonal_naive": 432, "moving_average_24h": 577}


def test_histogram(spark):
    errors = hourly(spark, 300).withColumn("load_error_mw", (F.col("sequence_id") % 31).cast("double"))
    bins = evaluation.error_histogram(errors).orderBy("bin").collect()
    assert sum(b.n for b in bins) == 200
    assert bins[0].bin_start == 0.0 and bins[-1].bin_end == pytest.approx(30.0)
    assert evaluation.error_histogram(errors.limit(10)).count() == 0
    flat = hourly(spark, 20).withColumn("load_error_mw", F.lit(1.0))
    assert [b.n for b in evaluation.error_histogram(flat).collect()] == [20]


def test_status(spark):
    as_of = F.lit("2010-01-07 23:00:00").cast("timestamp_ntz")
    row = evaluation.replay_status(hourly(spark, 200), as_of).first()
    assert (row.events_emitted, row.events_remaining, row.progress_pct) == (168, 32, 84.0)
    assert row.buffer_warm is True


# Token bucket


def simulate(events, capacity, rate):
    """Step by step: (arrival seconds, cost) in order -> leaving times."""
    tokens, last, free, out = capacity, None, -math.inf, []
    for t, cost in events:
        now = max(t, free)
        tokens = capacity if last is None else min(capacity, tokens + (now - last) * rate)
        last = now
        if tokens < cost:
            wait = (cost - tokens) / rate
            now, tokens, last = now + wait, cost, now + wait
        tokens -= cost
        free = now
        out.append(now)
    return out


@pytest.mark.parametrize("chunk", [None, 40])
@pytest.mark.parametrize("capacity,rate", [(5.0, 10.0), (1.0, 0.1), (10.0, 0.5), (3.0, 1.0)])
def test_release_equals_simulation(spark, capacity, rate, chunk):
    import random

    rng, t, events = random.Random(7), 0.0, []
    for i in range(300):
        t += rng.choice([0.0, 0.0, 0.25, 1.0, 9.0])
        events.append((i, t, float(rng.choice([1, 1, 1])) if capacity < 2 else float(rng.choice([1, 2, 3]))))
    df = spark.createDataFrame(events, "event_id long, s double, cost double").select(
        F.lit("k").alias("k"),
        "event_id",
        F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).cast("timestamp_ntz").alias("ts"),
        "s",
        "cost",
    )
    got = release.release_schedule(
        df, ["k"], "ts", "event_id", capacity, rate, cost="cost", rows_per_chunk=chunk
    )
    want = simulate([(s, c) for _, s, c in events], capacity, rate)
    rows = got.orderBy("event_id").collect()
    assert [r.s + r.wait_s for r in rows] == pytest.approx(want, abs=1e-6)


def test_release_rejects(spark):
    df = hourly(spark, 3).withColumn("cost", F.lit(9.0))
    with pytest.raises(ValueError):
        release.release_schedule(df, ["panel_id"], "ts", "sequence_id", 0, 1)
    with pytest.raises(Exception, match="above bucket capacity"):
        release.release_schedule(
            df, ["panel_id"], "ts", "sequence_id", 5, 1, cost="cost"
        ).collect()


# Requests


def request_table(spark, n):
    rows = noisy(spark, n)
    arrays = [F.transform(F.array_sort(F.collect_list(F.struct("ts", z))), lambda s: s[z]).alias(z) for z in SIX.zones]
    return rows.groupBy("panel_id").agg(F.max("ts").alias("ts"), *arrays).withColumn(
        "request_id", F.lit(1).cast("long")
    )


def test_request_features_equal_the_window_form(spark):
    for n in (168, 200):
        table = request_table(spark, n)
        expanded = requests.expand_requests(table, SIX)
        assert expanded.count() == 168
        spec = type(SIX)(SIX.target, SIX.others, panel="request_id")
        by_windows = build_features_online_compat(expanded, spec, max_rows=168)
        direct = requests.request_features(table, SIX)
        same(direct, by_windows, 6)


def test_parity_requests_equal_the_training_features(spark):
    """The request of a row, with all values up to it, has the row's features in the matrix."""
    for n in (169, 200):
        table = request_table(spark, n)
        direct = requests.request_features(table, SIX, convention="parity")
        matrix = build_features(noisy(spark, n), SIX, with_target=False, max_rows=n)
        last = matrix.filter(F.col("ts") == table.first()["ts"]).drop("panel_id")
        same(direct.drop("request_id"), last, 6)
        assert direct.count() == 1
        assert requests.expand_requests(table, SIX, convention="parity").count() == 169
    assert requests.request_features(request_table(spark, 168), SIX, convention="parity").count() == 0
    with pytest.raises(ValueError):
        requests.request_features(table, SIX, convention="other")


def test_latency_that_was_not_measured_is_null(spark):
    rows = spark.createDataFrame([(1, 100.26)], "request_id long, p double").withColumn(
        "ts", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    )
    plain, timed = (
        requests.answer_requests(rows, SIX, "p", "m", latency_ns=latency).first()
        for latency in (None, F.lit(2_345_678))
    )
    assert plain.inference_latency_ms is None and timed.inference_latency_ms == 2.35
    assert plain.load_forecast_mw == 100.3 and str(plain.timestamp_predicted) == "2020-01-01 01:00:00"


def test_request_validation(spark):
    table = request_table(spark, 168).withColumn("dom", F.slice("dom", 1, 167))
    row = requests.validate_requests(table, SIX).first()
    assert (row.status, row.n_values) == ("rejected", 167)
    assert row.reason == "shortest array has 167 values, 168 needed"
    assert requests.request_features(table, SIX).count() == 0


@pytest.mark.parametrize("chunk,far", [(None, 10**9), (400, 200)])
def test_prefix_percentiles(spark, chunk, far):
    """Exact at every block, with nulls, ties, negatives and groups of unequal length."""
    import numpy as np

    from loadweave.operators.prefix_quantiles import prefix_percentiles

    rng = np.random.default_rng(7)
    rows = []
    for key, n, reach in (("a", 900, far), ("b", 130, 3), ("c", 24, 1), (None, 30, 100)):
        rows += [(key, i // 10, None if i % 7 == 3 else int(rng.integers(-reach, reach))) for i in range(n)]
    values = spark.createDataFrame(rows, "k string, b long, v long")
    counted = {}
    for key, b, v in rows:
        counted.setdefault((key, b), []).extend([] if v is None else [v])
    asked, want, points = [], {}, (0.0, 0.25, 0.5, 0.99, 1.0)
    for key in ("a", "b", "c", None):
        so_far = []
        for b in sorted(x for k, x in counted if k == key):
            so_far = so_far + counted[key, b]
            asked.append((key, b, len(so_far)))
            want[key, b] = np.quantile(so_far, points) / 10
    asked = spark.createDataFrame(asked, "k string, b long, n long").filter("k is not null")
    names = [f"q{i}" for i in range(len(points))]
    args = (["k"], "b", "v", "n", points, names, 10.0, None, chunk)
    got = prefix_percentiles(values.filter("k is not null"), asked, *args).collect()
    assert len(got) == asked.count()
    for r in got:
        assert list(r)[2:] == pytest.approx(list(want[r["k"], r["b"]]))
    none = prefix_percentiles(values.filter("false"), asked.filter("false"), *args)
    assert none.count() == 0 and none.columns == ["k", "b", *names]


def test_csv_files_with_different_headers(spark, tmp_path):
    settings = Settings(target_zone="T", other_zones=("O",))
    spec = type(SIX)(target="t", others=("o",))
    (tmp_path / "a b.csv").write_text('Datetime,T,O\n2010-01-01 00:00:00,1,2\n2010-01-01 01:00:00,NaN,4\n')
    (tmp_path / "c.csv").write_text('"O","no, te",Datetime,T\n20,"x, y",2010-01-01 00:00:00,10\n,z,2010-01-01 02:00:00,3\n')
    (tmp_path / "d.csv").write_text("O,no,Datetime,T\n6,,2010-01-01 03:00:00,-5\n7,,2010-01-01 03:00:00,-6\n")
    (tmp_path / "e.csv").write_text("")
    raw = readers.read_panel_csv(spark, str(tmp_path), settings)
    assert raw.count() == 6 and dict(raw.dtypes)["ingest_seq"] == "decimal(38,0)"
    once = cleaning.dedup_last(raw, ["panel_id", "ts"], "ingest_seq")
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    rows = sorted((r.ts.hour, r.t, r.o) for r in cleaning.clean(raw, spec).collect())
    assert rows == [(0, 10.0, 20.0), (3, 0.0, 7.0)]
    (tmp_path / "f.csv").write_text("Datetime,T\n2010-01-01 00:00:00,1\n")
    with pytest.raises(readers.MissingColumns, match="f.csv"):
        readers.read_panel_csv(spark, str(tmp_path), settings)
