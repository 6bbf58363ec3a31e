"""What made time or space grow faster than the data: plans, copies, micro-batches."""

import math
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from catalog import models, streams
from catalog.fixtures import six
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.operators import forecasting, histograms, prefix_quantiles, requests
from loadweave.operators.features import build_features
from loadweave.plans import layout
from loadweave.session import scratch_path
from loadweave.settings import PanelSpec, Settings
from loadweave.sources import readers
from loadweave.streaming import flows, state
from tests.helpers import SIX, noisy, same


def test_six_decimals_are_those_of_round(spark):
    values = [0.0078125, -0.0078125, 2.0000005, 0.1234565, -1e-7, -0.0, 1e15 / 3, math.inf, math.nan, 5.0]
    values += [i / 7 for i in range(-500, 500)] + [i / 128 + 1e5 for i in range(500)] + [None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows.select(six("v").alias("a"), F.round("v", 6).alias("b"))
    assert got.filter(~F.col("a").cast("string").eqNullSafe(F.col("b").cast("string"))).count() == 0


def test_whole_panels_give_the_rows_of_chunks(spark):
    """Without a window operator for the history, also where values are missing or no numbers."""
    rows = noisy(spark, 420).unionByName(noisy(spark, 200, "q")).unionByName(noisy(spark, 100, "r"))
    s = F.col("sequence_id")
    rows = rows.withColumn("pjmw", F.when(s != 250, F.col("pjmw")))
    rows = rows.withColumn("aep", F.when(s == 300, F.lit(math.nan)).otherwise(F.col("aep")))
    for drop in (True, False):
        whole = build_features(rows, SIX, keep=("sequence_id",), drop=drop)
        assert "Window" not in whole._jdf.queryExecution().optimizedPlan().toString()
        same(whole, build_features(rows, SIX, keep=("sequence_id",), drop=drop, rows_per_chunk=60))


def test_deviation_of_a_request_takes_its_mean_once(spark):
    made = requests._std(F.col("x"))
    assert str(made).count("aggregate(") == 2
    x = [float(v) for v in np.random.default_rng(1).integers(0, 50, 168)]
    got = spark.createDataFrame([(x,)], "x array<double>").select(made).first()[0]
    assert got == pytest.approx(np.std(x, ddof=1))


def test_few_trees_make_no_copy_of_their_rows(spark, monkeypatch):
    rows = noisy(spark, 300).withColumn("target", F.col("aep"))
    rows = forecasting.assembler(SIX.zones).transform(rows).select(
        "features", "target", (F.col("sequence_id") % 3 == 0).alias("held_out")
    ).cache()
    copies = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: copies.append(1) or self)
    found = forecasting.boost(rows, Settings(tree_depth=2), rounds=2, patience=2)
    assert found.trees and not copies


@pytest.mark.parametrize("patience", [None, 3])
def test_many_rows_get_the_trees_of_spark_ml(spark, patience, monkeypatch):
    monkeypatch.setattr(forecasting, "CHECKPOINT_EVERY", 2)
    rows = noisy(spark, 600).withColumn("target", F.col("aep") * 2 + F.col("pjme"))
    held_out = (F.pmod(F.xxhash64("sequence_id"), F.lit(3)) == 0).alias("held_out")
    draw = F.xxhash64("sequence_id").alias("_draw")
    rows = rows.select("target", held_out, draw, "sequence_id", *SIX.zones).repartition(4).cache()
    vectors = forecasting.assembler(SIX.zones).transform(rows).select("features", "target", "held_out")
    settings = Settings(tree_depth=4)
    want = forecasting.boost(vectors, settings, 5, patience)
    _, (fit,) = histograms.fits_of(rows, SIX.zones, [F.col("held_out").cast("int")], F.col("_draw"))
    got = forecasting.boost_many(fit, settings, 5, patience)
    assert got.base == pytest.approx(want.base) and len(got.trees) == len(want.trees)
    assert got.errors == pytest.approx(want.errors, rel=1e-9)
    assert got.importances == pytest.approx(want.importances, abs=1e-9)
    a, b = (forecasting.as_model(m, SIX.zones).transform(rows) for m in (got, want))
    same(a.select("sequence_id", "prediction"), b.select("sequence_id", "prediction"), 6)


def test_many_rows_are_fitted_without_new_bins_for_every_tree(spark, monkeypatch):
    known = build_features(_panels(spark), SIX, max_rows=400)
    few = Settings(trees=3, patience=2, tree_depth=1)
    want = forecasting.fit_walk_forward(known, SIX, few, max_rows=400)
    monkeypatch.setattr(forecasting, "FEW_ROWS", 0)
    monkeypatch.setattr(forecasting, "DecisionTreeRegressor", None)
    got = forecasting.fit_walk_forward(known, SIX, few, max_rows=400)
    assert got.n_rows == want.n_rows
    same(got.folds, want.folds, 6)
    assert got.importances == pytest.approx(want.importances, abs=1e-6)


def test_a_replay_has_a_micro_batch_for_each_slice(spark):
    rows = noisy(spark, 30).select("sequence_id", "ts", *SIX.zones)
    rows = rows.withColumn("panel_id", F.explode(F.array(*[F.lit(f"p{i}") for i in range(20)])))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stream = streams._replay(spark, rows, slices=3)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    checkpoint = scratch_path(spark, "checkpoint")
    table = flows.run_to_end(stream, scratch_path(spark, "out"), checkpoint)
    same(table, rows)
    batches = [p for p in Path(checkpoint.removeprefix("file:")).glob("commits/[0-9]*")]
    assert len(batches) == 3


def _panels(spark, n=400):
    rows = noisy(spark, n).drop("sequence_id", "panel_id")
    names = F.array(F.lit("a"), F.lit("b"), F.lit(None).cast("string"))
    return rows.withColumn("panel_id", F.explode(names))


def test_training_reads_its_panel_once(spark):
    panel = _panels(spark)
    read = spark.sparkContext.accumulator(0)

    def seen(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    few = Settings(trees=1, patience=1, tree_depth=1)
    trained, baselines = forecasting.train(panel.mapInPandas(seen, panel.schema), SIX, few, 400)
    assert read.value == 3 * 400
    assert trained.n_rows == 3 * (320 - 169) and baselines.count() == 3


def test_folds_are_cut_without_a_shuffle_of_the_features(spark):
    known = build_features(_panels(spark), SIX, max_rows=400)
    twice = known.filter("day_of_year = 9").withColumn("panel_id", F.lit("b"))  # times again
    written = forecasting.training_rows(known.unionByName(twice), SIX)
    rows = forecasting.with_cuts(written, SIX, Settings(), embargo=7, max_rows=600)
    assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().toString()
    place, sizes = F.col("_place"), {}
    for r in written.groupBy("panel_id").count().collect():
        sizes[r.panel_id] = r["count"]
    assert len(set(sizes.values())) == 2
    for fold in range(1, 5):
        held = place >= F.col(f"_from_{fold}")
        if fold < 4:
            held = held & (place < F.col(f"_from_{fold + 1}"))
        got = rows.groupBy("panel_id").agg(
            F.count_if(held).alias("held"), F.count_if(place < F.col(f"_until_{fold}")).alias("known")
        )
        for r in got.collect():
            n, block = sizes[r.panel_id], sizes[r.panel_id] // 5
            assert r.held == (block if fold < 4 else n - 4 * block)
            assert r.known == block * fold - 7


def test_held_out_rows_read_the_stored_panel(spark, tmp_path, monkeypatch):
    day = F.timestamp_add("DAY", F.col("id"), F.lit("2020-01-01").cast("timestamp_ntz"))
    rows = spark.range(5).select(
        day.alias("l_shipdate"),
        F.lit("A").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
        F.col("id").cast("double").alias("l_quantity"),
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    made, reads = models.X.panel_daily, []
    monkeypatch.setattr(models.X, "panel_daily", lambda *a: reads.append(1) or made(*a))
    for _ in range(2):
        _, steps = models._holdout(spark, str(tmp_path))
        assert steps == 5
    assert len(reads) == 1
    same(models._panel_daily(spark, str(tmp_path))[0], made(spark, str(tmp_path))[0])


class _Calls:
    """A state variable, and a handle that gives it under any name, counting the calls."""

    def __init__(self):
        self.calls, self.kept = 0, {}

    def getValueState(self, name, schema):
        return _Value(self, name)

    def getMapState(self, name, *schemas):
        return _Map(self, name)


class _Value:
    def __init__(self, handle, name):
        self.handle, self.name = handle, name

    def exists(self):
        self.handle.calls += 1
        return self.name in self.handle.kept

    def get(self):
        self.handle.calls += 1
        return self.handle.kept.get(self.name)

    def update(self, value):
        self.handle.calls += 1
        self.handle.kept[self.name] = value


class _Map(_Value):
    def _at(self, key):
        self.handle.calls += 1
        return (self.name, key)

    def containsKey(self, key):
        return self._at(key) in self.handle.kept

    def getValue(self, key):
        return self.handle.kept[self._at(key)]

    def updateValue(self, key, value):
        self.handle.kept[self._at(key)] = value

    def removeKey(self, key):
        del self.handle.kept[self._at(key)]

    def keys(self):
        self.handle.calls += 1
        return [k[1] for k in self.handle.kept if k[0] == self.name and isinstance(k, tuple)]


def _hours(n):
    rows = pd.DataFrame({"panel_id": "p", "us": np.arange(n) * 3_600_000_000, "sequence_id": np.arange(n)})
    rng = np.random.default_rng(2)
    return rows.assign(arrival=rows["sequence_id"], **{z: rng.random(n) for z in SIX.zones})


def test_a_panels_micro_batch_is_one_frame_and_few_state_calls():
    handle, hour = _Calls(), 3_600_000_000
    made = state.ArrivalHistory(SIX, Settings(), 16 * hour, "label")
    rows = _hours(600)
    for i, part in enumerate((rows[:300], rows[300:])):
        made.init(handle)
        handle.calls = 0
        late = part.head(3).assign(us=-hour, arrival=10**6)
        frames = list(made.handleInputRows(("p",), iter([pd.concat([part, late])]), None))
        assert len(frames) == 1
        assert set(frames[0]["kind"]) == ({"feature", "warmup", "late"} if i == 0 else {"feature", "late"})
        # clock and history are read and written; 8 or 9 open buckets are written, and those before taken
        assert handle.calls <= 4 + 9 * (1 if i == 0 else 3)
    assert len(made.open) <= 9


def test_a_panels_rows_travel_to_and_from_state_as_one_value(spark, monkeypatch):
    monkeypatch.setattr(state, "PACK_ROWS", 100)
    rows = _panels(spark, 300).select("panel_id", F.lit(1).cast("long").alias("sequence_id"), "ts", *SIX.zones)
    record = state.history_record(SIX)
    plain = rows.select("panel_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "sequence_id", *SIX.zones)
    schema = f"panel_id string, {state.PACKED} binary"
    sent = plain.coalesce(1).mapInArrow(state.packed_rows("panel_id", record), schema).collect()
    assert {r.panel_id for r in sent} == {"a", "b", None} and len(sent) <= 3 * 9
    made = state.PanelHistory(SIX, Settings(), "label", packed=True)
    made.init(_Calls())
    frames = (pd.DataFrame({state.PACKED: [r[1]]}) for r in sent if r.panel_id == "a")
    (got,) = made.handleInputRows(("a",), frames, None)
    assert list(got.columns) == ["panel_id", state.PACKED] and len(got) == 1
    back = spark.createDataFrame(got, schema).mapInArrow(state.unpacked_rows(made.schema), made.schema)
    want = build_features(rows.filter("panel_id = 'a'"), SIX)
    shown = ["panel_id", *[n for n in state.history_names(SIX, Settings()) if not n.startswith("_")], "target"]
    same(back.select(shown), want.select(shown))


def test_sums_and_latencies_are_one_state_value():
    handle = _Calls()
    for start in (0, 60):
        made = state.RunningSums(every=24, latency=True)
        made.init(handle)
        handle.calls = 0
        part = pd.DataFrame({"sequence_id": np.arange(start, start + 60), "latency_ns": np.arange(start, start + 60)})
        part = part.assign(**dict.fromkeys(state.SUM_TERMS, 1.0))
        (got,) = made.handleInputRows(("p",), iter([part]), None)
        assert handle.calls == 2
    assert got["events_processed"].tolist() == [72, 96, 120] and got["l_abs"].tolist() == [72.0, 96.0, 120.0]
    assert got["p50_ms"].tolist() == pytest.approx([35.5e-6, 47.5e-6, 59.5e-6])


def test_filled_rows_of_a_task_do_not_grow_with_the_panels(spark, monkeypatch):
    monkeypatch.setattr(layout, "TASK_ROWS", 1000)
    day = F.timestamp_add("DAY", F.col("id") % 50, F.lit("2020-01-01").cast("timestamp_ntz"))
    rows = spark.range(400).select(F.col("id").cast("string").alias("panel_id"), day.alias("ts"), F.lit(1.0).alias("a"))
    first, steps = readers.span(rows, "ts", "day")
    dense = readers.densify(rows, PanelSpec("a", ()), first, steps, "day", panels=400)
    tasks = [r["count"] for r in dense.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 400 * 50 and max(tasks) < 2000
    same(dense, readers.densify(rows, PanelSpec("a", ()), first, steps, "day"))


def test_ranks_in_the_same_digits_travel_in_one_row(spark, monkeypatch):
    values = spark.range(96).select(F.lit("p").alias("k"), (F.col("id") / 24).cast("long").alias("b"), (F.col("id") * 37 % 96).alias("v"))
    asked = spark.range(4).select(F.lit("p").alias("k"), F.col("id").alias("b"), ((F.col("id") + 1) * 24).alias("n"))
    run, sizes = prefix_quantiles.running, []
    monkeypatch.setattr(prefix_quantiles, "running", lambda laid, df, sums: sizes.append(df.count()) or run(laid, df, sums))
    points, names = [i / 10 for i in range(11)], [f"q{i}" for i in range(11)]
    got = prefix_quantiles.prefix_percentiles(values, asked, ["k"], "b", "v", "n", points, names, max_rows=4)
    assert sizes[0] == 4 + 4  # a row of counts and one of ranks for each block, not 22 of ranks
    for r in got.collect():
        so_far = [i * 37 % 96 for i in range((r["b"] + 1) * 24)]
        assert list(r)[2:] == pytest.approx(list(np.quantile(so_far, points)))


def test_the_manifest_of_a_micro_batch_starts_no_python_worker(spark):
    made = flows.manifest_of(spark, {7: 1, 3: 0})
    assert "LocalRelation" in made._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, made.collect())) == [(3, 0), (7, 1)]
    assert made.schema.simpleString() == "struct<bucket:int,slot:int>"
    assert flows.manifest_of(spark, {}).count() == 0
