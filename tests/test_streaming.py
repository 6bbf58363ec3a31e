"""Streams give what the batch operators give."""

import datetime
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadweave.operators import evaluation
from loadweave.operators.features import (
    build_features,
    build_features_online_compat,
    feature_names,
)
from loadweave.session import scratch_path
from loadweave.settings import Settings
from loadweave.sources import sinks
from loadweave.streaming import flows
from tests.helpers import SIX, noisy, same
from tests.test_operators import results

SHOWN = ["panel_id", "ts", "sequence_id", *feature_names(SIX)]


def two_panels(spark, n=400):
    rows = noisy(spark, n).unionByName(noisy(spark, n - 150, "q"))
    return rows.select("panel_id", "sequence_id", "ts", *SIX.zones)


def replay(spark, rows, slices=3, order="sequence_id", schema=None):
    path = scratch_path(spark, "replay")
    sinks.write_replay(rows, path, order=order, slices=slices)
    return flows.replay_source(spark, path, schema or rows.schema)


def drain(spark, stream):
    return flows.run_to_end(stream, scratch_path(spark, "out"), scratch_path(spark, "checkpoint"))


def test_label_mode_equals_batch(spark):
    rows = two_panels(spark)
    got = drain(spark, flows.online_features(replay(spark, rows), SIX, mode="label"))
    want = build_features(rows, SIX, keep=("sequence_id",))
    same(got.select(*SHOWN, "target"), want.select(*SHOWN, "target"))


def test_missing_readings_leave_the_same_rows_as_in_batch(spark):
    rows = two_panels(spark).withColumn("pjme", F.when(F.col("sequence_id") != 250, F.col("pjme")))
    got = drain(spark, flows.online_features(replay(spark, rows), SIX, mode="label"))
    want = build_features(rows, SIX, keep=("sequence_id",))
    same(got.select(*SHOWN, "target"), want.select(*SHOWN, "target"))
    served = drain(spark, flows.online_features(replay(spark, rows), SIX))
    unlabelled = build_features(rows, SIX, keep=("sequence_id",), with_target=False)
    same(served.select(*SHOWN), unlabelled.select(*SHOWN))


def test_serve_mode_and_compat(spark):
    rows = two_panels(spark)
    got = drain(spark, flows.online_features(replay(spark, rows), SIX))
    want = build_features(rows, SIX, keep=("sequence_id",), with_target=False)
    same(got.select(*SHOWN), want.select(*SHOWN))
    got = drain(spark, flows.online_features(replay(spark, rows), SIX, convention="online_compat"))
    want = build_features_online_compat(rows, SIX, keep=("sequence_id",))
    same(got.select(*SHOWN), want.select(*SHOWN))


def test_duplicated_events_are_harmless(spark):
    rows = two_panels(spark)
    twice = rows.unionByName(rows.filter("sequence_id % 50 = 7"))
    path = scratch_path(spark, "replay")
    sinks.write_replay(twice, path, slices=3)
    rows.filter("sequence_id < 30").write.mode("append").parquet(path)  # an old file again
    stream = flows.replay_source(spark, path, rows.schema)
    got = drain(spark, flows.online_features(stream, SIX))
    want = build_features(rows, SIX, keep=("sequence_id",), with_target=False)
    same(got.select(*SHOWN), want.select(*SHOWN))


@pytest.mark.parametrize("chunk", [None, 120])
def test_windowed_batches_equal_batch(spark, chunk):
    rows = two_panels(spark)
    got = flows.run_windowed(
        replay(spark, rows), SIX, Settings(), scratch_path(spark, "windowed"), chunk
    )
    want = build_features(rows, SIX, keep=("sequence_id",), with_target=False)
    same(got.select(*SHOWN), want.select(*SHOWN))


def test_windowed_batches_move_only_the_buckets_they_touch(spark):
    """Panels in buckets of their own; a batch of one panel leaves the others' files alone, and
    a batch that runs again, as after a lost driver, changes nothing."""
    base = noisy(spark, 420).select("panel_id", "sequence_id", "ts", *SIX.zones).drop("panel_id")
    rows = base.withColumn("panel_id", F.explode(F.array(*[F.lit(f"p{i}") for i in range(6)])))
    rows = rows.select("panel_id", "sequence_id", "ts", *SIX.zones)
    work = scratch_path(spark, "buckets").removeprefix("file:")
    process = flows.windowed_batches(SIX, Settings(), f"{work}/tails", f"{work}/out", buckets=64)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in Path(f"{work}/tails/rows").rglob("*.parquet")}

    parts = [
        rows.filter("sequence_id < 200"),
        rows.filter("panel_id = 'p3' and sequence_id between 200 and 300"),
        rows.filter("sequence_id >= 200"),
        rows.filter("panel_id = 'p3' and sequence_id < 0"),
    ]
    process(parts[0], 0)
    first = files()
    process(parts[1], 1)
    second = files()
    assert first.items() <= second.items() and len(second) == len(first) + 1
    process(parts[1], 1)
    process(parts[2], 2)
    process(parts[2], 2)
    third = files()
    process(parts[3], 3)  # without a row: nothing is written but the manifest
    assert files() == third and len(third) == 12
    made = spark.read.option("basePath", f"{work}/out").parquet(f"{work}/out/batch=*").drop("batch")
    want = build_features(rows, SIX, keep=("sequence_id",), with_target=False)
    same(made.select(*SHOWN), want.select(*SHOWN))


def test_disorder_within_the_delay(spark):
    """Rows arrive up to 8 places out of order; what leaves is in order and complete up
    to the final watermark."""
    rows = noisy(spark, 420).select("panel_id", "sequence_id", "ts", *SIX.zones)
    arrived = rows.withColumn("arrival", F.col("sequence_id") + (F.col("sequence_id") * 7) % 9)
    stream = replay(spark, arrived, slices=5, order="arrival", schema=rows.schema)
    got = drain(spark, flows.online_features(stream, SIX, delay="12 hours"))
    want = build_features(rows, SIX, keep=("sequence_id",), with_target=False)
    top = got.agg(F.max("sequence_id")).first()[0]
    assert top >= 400
    same(got.select(*SHOWN), want.filter(F.col("sequence_id") <= top).select(*SHOWN))


def test_too_late_rows_are_dropped(spark):
    rows = noisy(spark, 420).select("panel_id", "sequence_id", "ts", *SIX.zones)
    late = F.when(F.col("sequence_id") == 100, F.lit(300)).otherwise(F.lit(0))
    arrived = rows.withColumn("arrival", F.col("sequence_id") + late)
    stream = replay(spark, arrived, slices=5, order="arrival", schema=rows.schema)
    got = drain(spark, flows.online_features(stream, SIX, delay="2 hours"))
    without = rows.filter("sequence_id != 100")
    want = build_features(without, SIX, keep=("sequence_id",), with_target=False)
    top = got.agg(F.max("sequence_id")).first()[0]
    assert top >= 410
    same(got.select(*SHOWN), want.filter(F.col("sequence_id") <= top).select(*SHOWN))


def test_snapshots_equal_batch(spark):
    rows = results(spark, 200).unionByName(
        results(spark, 100).withColumn("panel_id", F.lit("q"))
    )
    got = drain(spark, flows.stream_snapshots(replay(spark, rows), every=24))
    same(got, evaluation.cumulative_snapshots(rows))
    assert got.count() == 8 + 4


def test_messages(spark):
    rows = results(spark, 30)
    table = drain(spark, flows.stream_messages(replay(spark, rows)))
    parsed = sinks.parse_messages(table, sinks.FORECAST_SCHEMA)
    assert parsed.count() == 30
    row = parsed.filter("sequence_id = 5").first()
    assert row.logical_timestamp == "2010-01-01T05:00:00" and row.type == "forecast"
    assert row.load_error_mw == row.load_forecast_mw - row.load_actual_mw
    assert row.inference_latency_ms == 0.005


def arrivals(spark, n=420, panel="p"):
    """Events with their arrival number: up to 8 places out of order, some far too late, some
    delivered twice, one without a time."""
    rows = noisy(spark, n, panel).select("panel_id", "sequence_id", "ts", *SIX.zones)
    s = F.col("sequence_id")
    very_late = F.when(s % 97 == 13, F.lit(150)).otherwise(F.lit(0))
    came = rows.withColumn("arrival", s + (s * 7) % 9 + very_late)
    again = came.filter(s % 50 == 7).withColumn("arrival", F.col("arrival") + 2)
    changed = again.withColumn("pjme", F.col("pjme") + 5)
    old = came.filter(s % 100 == 3).withColumn("arrival", F.col("arrival") + 200)
    lost = came.filter("sequence_id = 11").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    return came.unionByName(changed).unionByName(old).unionByName(lost)


def told(rows, hours=12):
    """Kind of every arrival by the rules, in plain Python, and the events that go on."""
    newest, late, waiting, untimed = None, [], {}, []
    for r in sorted(rows, key=lambda r: (r.arrival, r.ts is not None, r.ts, r.sequence_id)):
        if r.ts is None:
            untimed.append(r)
        elif newest is not None and r.ts <= newest - datetime.timedelta(hours=hours):
            late.append(r)
        else:
            waiting.setdefault(r.ts, []).append(r)
            newest = r.ts if newest is None else max(newest, r.ts)
    kept = [rs[-1] for rs in waiting.values()]
    repeated = [r for rs in waiting.values() for r in rs[:-1]]
    return kept, {"late": late, "repeated": repeated, "untimed": untimed}


@pytest.mark.parametrize("slices,mode", [(1, "serve"), (7, "label")])
def test_every_arrival_leaves_once_with_its_kind(spark, slices, mode):
    rows = arrivals(spark).unionByName(arrivals(spark, 200, "q")).unionByName(arrivals(spark, 5, "r"))
    path = scratch_path(spark, "replay")
    sinks.write_replay(rows, path, order="arrival", slices=slices, end_marks=True)
    stream = flows.replay_source(spark, path, rows.schema)
    made = flows.tagged_features(stream, SIX, delay="12 hours", mode=mode, arrival="arrival")
    got = drain(spark, made).cache()
    features = None
    for panel in ("p", "q", "r"):
        came = rows.filter(F.col("panel_id") == panel).collect()
        kept, want = told(came)
        mine = got.filter(F.col("panel_id") == panel)
        for kind, those in want.items():
            found = [r.sequence_id for r in mine.filter(F.col("kind") == kind).collect()]
            assert sorted(found) == sorted(r.sequence_id for r in those), (panel, kind)
        in_order = spark.createDataFrame(kept, rows.schema)
        batch = build_features(in_order, SIX, keep=("sequence_id",), with_target=mode == "label")
        features = batch if features is None else features.unionByName(batch)
        n = {r["kind"]: r["count"] for r in mine.groupBy("kind").count().collect()}
        assert n["end"] == 1 and n.get("open", 0) == (mode == "label")
        assert sum(c for k, c in n.items() if k != "end") == len(came)
        end = mine.filter("kind = 'end'").first()
        counted = (end.n_in, end.n_late, end.n_repeated, end.n_untimed)
        assert counted == (len(came), len(want["late"]), len(want["repeated"]), len(want["untimed"]))
    shown = SHOWN + (["target"] if mode == "label" else [])
    same(got.filter("kind = 'feature'").select(*shown), features.select(*shown))


def test_no_waiting_row_is_written_twice(spark):
    """State grows by what arrives: a chunk per bucket and micro-batch, none rewritten."""
    from loadweave.streaming.state import ArrivalHistory

    class Kept(dict):
        written = 0

        def updateValue(self, k, v):
            self[k], self.written = v, self.written + len(v[0] if isinstance(v[0], bytes) else b"")

        getValue, containsKey, removeKey = dict.__getitem__, dict.__contains__, dict.pop

    state = ArrivalHistory(SIX, Settings(), 3_600_000_000 * 100)
    state.open, state.chunks = Kept(), Kept()
    rng = np.random.default_rng(1)
    taken = 0
    for i in range(40):
        part = np.zeros(25, dtype=state.record)
        part["us"] = rng.integers(i * 10, i * 10 + 60, 25) * 3_600_000_000
        state._wait(part)
        taken += len(state._passed((i * 10 - 40) * 3_600_000_000))
    taken += len(state._passed(2**62))
    assert taken == 1000 and not state.open and not state.chunks
    assert state.chunks.written == 1000 * np.dtype(state.record).itemsize


def test_a_replay_sent_twice_gives_the_rows_of_one(spark):
    rows = two_panels(spark)
    path = scratch_path(spark, "replay")
    for _ in range(2):
        sinks.write_replay(rows, path, slices=3)
    rows.filter("sequence_id between 100 and 180").write.mode("append").parquet(path)
    got = drain(spark, flows.once(flows.replay_source(spark, path, rows.schema), "6 hours"))
    same(got, rows)


def test_streamed_latency_is_near_the_exact_one(spark):
    rows = results(spark, 400).withColumn(
        "latency_ns", F.when(F.col("sequence_id") % 9 != 4, (F.col("sequence_id") * 7919) % 5003 * 1000)
    )
    got = drain(spark, flows.stream_snapshots(replay(spark, rows), every=24, latency=True))
    same(got, evaluation.cumulative_snapshots(rows, latency=True))


def test_sketch_stays_within_its_error():
    from loadweave.streaming.state import QuantileSketch

    rng = np.random.default_rng(3)
    n = 200_000
    for values in (rng.integers(0, 10**9, n), np.arange(n), np.arange(n)[::-1], rng.integers(0, 5, n)):
        whole, halves = QuantileSketch(), [QuantileSketch(), QuantileSketch()]
        for i, at in enumerate(range(0, n, 3001)):
            whole.add(values[at : at + 3001])
            whole = QuantileSketch(whole.to_bytes())
            halves[i % 2].add(values[at : at + 3001])
        halves[0].merge(halves[1])
        points = np.linspace(0, 1, 41)
        for sketch in (whole, halves[0]):
            error = len(sketch.levels) / QuantileSketch.CAPACITY
            assert error < 0.01 and sum(map(len, sketch.levels)) < 12_000
            low = np.quantile(values, np.clip(points - error, 0, 1))
            high = np.quantile(values, np.clip(points + error, 0, 1))
            found = sketch.quantiles(points)
            assert (found >= low).all() and (found <= high).all()
    assert np.isnan(QuantileSketch().quantiles([0.5])).all()
