"""Streams: replay source, online features, scoring, snapshots, messages, sinks."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweave.functions import metrics as M
from loadweave.functions.expressions import (
    calendar,
    clip_low,
    micros,
    nan_to_null,
    price,
    ratio,
)
from loadweave.operators.evaluation import forecast_errors, latest, two_stage
from loadweave.operators.features import (
    build_features,
    drop_warmup,
    feature_names,
    history_rows,
    telling_columns,
)
from loadweave.operators.forecasting import score
from loadweave.plans.joins import attach
from loadweave.session import ROCKSDB_PROVIDER, ship_package
from loadweave.settings import PanelSpec, Settings
from loadweave.sources.sinks import forecast_messages
from loadweave.streaming.state import (
    COUNTERS,
    NONE,
    ArrivalHistory,
    PACKED,
    PanelHistory,
    RunningSums,
    arrival_record,
    history_record,
    output_schema,
    packed_rows,
    packed_schema,
    sums_record,
    sums_schema,
    tagged_schema,
    unpacked_rows,
)


MANIFEST = "bucket int, slot int"


def event_schema(spec: PanelSpec) -> T.StructType:
    fields = [
        T.StructField(spec.panel, T.StringType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField(spec.ts, T.TimestampNTZType()),
    ]
    return T.StructType(fields + [T.StructField(z, T.DoubleType()) for z in spec.zones])


def replay_source(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1
) -> DataFrame:
    """Parquet files as an ordered stream, a bounded number of files per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("latestFirst", "false")
        .parquet(path)
    )


def online_features(
    events: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    mode: str = "serve",
    convention: str = "parity",
    delay: str | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """The batch features, from keyed state: panel, ts, sequence_id, zones, features.

    ``mode="label"`` adds ``target``. ``delay`` puts events back in order that arrive up
    to that much later than a newer event of their panel; see ``tagged_features``, which
    also returns the events that come too late.
    """
    tail = ["target"] if mode == "label" else []
    shown = [spec.panel, spec.ts, "sequence_id", *spec.zones, *feature_names(spec, settings), *tail]
    if delay is not None:
        tagged = tagged_features(events, spec, settings, delay, mode, convention, arrival)
        return tagged.filter(F.col("kind") == "feature").select(*shown)
    spark = events.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    rows = events.select(
        spec.panel,
        micros(F.col(spec.ts)).alias("us"),
        F.col("sequence_id").cast("long").alias("sequence_id"),
        *[F.col(z).cast("double").alias(z) for z in spec.zones],
    )
    made = _packed(rows, spec.panel, history_record(spec)).transformWithStateInPandas(
        statefulProcessor=PanelHistory(spec, settings, mode, convention, packed=True),
        outputStructType=packed_schema(spec.panel),
        outputMode="Append",
        timeMode="None",
    )
    schema = output_schema(spec, settings)
    made = made.mapInArrow(unpacked_rows(schema), schema)
    known = {c: F.nullif(F.col(c), F.lit(NONE).cast("long")) for c in ("us", "sequence_id")}
    out = _with_row_features(made.withColumns(known), spec).select(*shown)
    if convention == "online_compat":
        return out
    # as in batch, a row with an unknown feature or target leaves no features
    return drop_warmup(out, telling_columns(spec, settings) + tail)


def _packed(rows: DataFrame, panel: str, record: np.dtype) -> GroupedData:
    """The rows of a micro-batch by panel, a panel's rows of a task as one binary value."""
    schema = T.StructType([rows.schema[panel], T.StructField(PACKED, T.BinaryType())])
    return rows.mapInArrow(packed_rows(panel, record), schema).groupBy(panel)


def _with_row_features(made: DataFrame, spec: PanelSpec) -> DataFrame:
    """``made`` (rows with their history columns) with the features that need no more history."""
    t = spec.target
    made = made.withColumn(spec.ts, F.timestamp_micros("us").cast("timestamp_ntz"))
    total = F.col(spec.zones[0])
    for z in spec.zones[1:]:
        total = total + F.col(z)
    first = F.col(spec.others[0])
    return made.withColumns(
        calendar(F.col(spec.ts))
        | {
            f"{t}_diff_1h": F.col(t) - F.col("_ago_1"),
            f"{t}_diff_24h": F.col(t) - F.col("_ago_24"),
            f"{t}_ratio_24h": ratio(F.col(t), F.col("_ago_24"), "fallback", 1.0),
            f"{t}_to_{spec.others[0]}_ratio": ratio(F.col(t), first, "fallback", 1.0),
            f"{t}_to_total_ratio": ratio(F.col(t), total, "fallback", 0.0),
            "target": nan_to_null(F.col("target")),
        }
    )


def tagged_features(
    events: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    delay: str = "1 day",
    mode: str = "serve",
    convention: str = "parity",
    arrival: str | None = None,
) -> DataFrame:
    """Every event once, with its ``kind``: feature, warmup, open, late, repeated or untimed;
    only ``feature`` rows have features. An end mark of a panel (``write_replay`` puts them
    last) makes all that waits leave, and an ``end`` row with the panel's counters.

    ``arrival`` names a whole number that orders the events of a micro-batch as they came;
    without it they count as having come in time order. See ``ArrivalHistory``.
    """
    spark = events.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    none = F.lit(NONE).cast("long")
    rows = events.select(
        spec.panel,
        F.coalesce(micros(F.col(spec.ts)), none).alias("us"),
        F.coalesce(F.col("sequence_id").cast("long"), none).alias("sequence_id"),
        (F.lit(0) if arrival is None else F.coalesce(F.col(arrival), F.lit(2**63 - 1)))
        .cast("long")
        .alias("arrival"),
        *[F.col(z).cast("double").alias(z) for z in spec.zones],
    )
    delay_us = int(pd.Timedelta(delay).total_seconds() * 1_000_000)
    tagged = _packed(rows, spec.panel, arrival_record(spec)).transformWithStateInPandas(
        statefulProcessor=ArrivalHistory(spec, settings, delay_us, mode, convention, packed=True),
        outputStructType=packed_schema(spec.panel),
        outputMode="Append",
        timeMode="None",
    )
    schema = tagged_schema(spec, settings)
    tagged = tagged.mapInArrow(unpacked_rows(schema), schema)
    known = {c: F.nullif(F.col(c), none) for c in ("us", "sequence_id", *COUNTERS)}
    names = feature_names(spec, settings)
    out = _with_row_features(tagged.withColumns(known), spec)
    if convention != "online_compat":
        lacking = F.lit(False)
        for name in telling_columns(spec, settings) + (["target"] if mode == "label" else []):
            lacking = lacking | F.col(name).isNull()
        kind = F.when((F.col("kind") == "feature") & lacking, F.lit("warmup")).otherwise(F.col("kind"))
        out = out.withColumn("kind", kind)
    feature = F.col("kind") == "feature"
    shown = [F.when(feature, F.col(n)).alias(n) for n in names]
    tail = [F.when(feature, F.col("target")).alias("target")] if mode == "label" else []
    return out.select(spec.panel, "kind", spec.ts, "sequence_id", *spec.zones, *shown, *tail, *COUNTERS)


def once(
    events: DataFrame,
    within: str,
    keys: tuple[str, ...] = ("panel_id", "sequence_id"),
    ts: str = "ts",
) -> DataFrame:
    """Each event once, however often it is delivered within ``within`` of its time.

    A key is kept in state until the watermark has passed its event by ``within``; what is
    delivered again after that is behind the watermark and dropped as such.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    marked = events.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", within)
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def stream_forecast(
    features: DataFrame,
    model: PipelineModel,
    spec: PanelSpec,
    settings: Settings = Settings(),
) -> DataFrame:
    """Score and price each micro-batch. Labelled features give full results; served
    ones give the forecast alone."""
    scored = score(features, model)
    if "target" in features.columns:
        return two_stage(
            scored,
            F.col("prediction"),
            F.col("target"),
            F.col("sequence_id"),
            settings=settings,
            keep=(spec.panel, spec.ts),
        )
    return scored.select(
        spec.panel,
        spec.ts,
        "sequence_id",
        clip_low(F.col("prediction")).alias("load_forecast_mw"),
    ).withColumn("price_forecast_usd_mwh", price(F.col("load_forecast_mw"), settings))


def stream_snapshots(
    results: DataFrame, panel: str = "panel_id", every: int = 24, latency: bool = False
) -> DataFrame:
    """Cumulative errors after every ``every`` results of a panel, as the batch operator.

    ``latency`` adds p50/p95/p99 in milliseconds of the results so far (0 where none was
    measured) from a sketch in state, see ``QuantileSketch`` for its error.
    """
    spark = results.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    terms = M.sum_terms(F.col("load_actual_mw"), F.col("load_forecast_mw"), "l_")
    terms |= M.sum_terms(F.col("price_actual_usd_mwh"), F.col("price_forecast_usd_mwh"), "p_")
    rows = results.select(
        panel,
        F.col("sequence_id").cast("long").alias("sequence_id"),
        *[c.cast("double").alias(n) for n, c in terms.items()],
        *([F.col("latency_ns").cast("long").alias("latency_ns")] if latency else ()),
    )
    sums = _packed(rows, panel, sums_record(latency)).transformWithStateInPandas(
        statefulProcessor=RunningSums(panel, every, latency),
        outputStructType=sums_schema(panel, latency),
        outputMode="Append",
        timeMode="None",
    )
    return sums.select(
        panel,
        F.call_function("div", F.col("events_processed"), F.lit(every)).alias("snapshot"),
        "events_processed",
        *M.from_terms("l_", "load_"),
        *M.from_terms("p_", "price_"),
        *(M.LATENCY_NAMES if latency else ()),
    )


def settle(
    forecasts: DataFrame,
    actuals: DataFrame,
    actual: str,
    step: str,
    wait: str,
    panel: str = "panel_id",
    ts: str = "ts",
) -> DataFrame:
    """Each forecast once, with the load that was measured ``step`` after its time.

    Both are streams and may lag each other: a forecast made at t waits in state for the
    panel's actual of t + ``step``, an early actual for its forecast. What has not come when
    both streams are ``wait`` past that time never will: the forecast then leaves with a NULL
    ``load_actual_mw``. The watermarks of both sides clear the state. An actual that is
    delivered repeatedly should pass ``once`` first, or it settles its forecast repeatedly.
    """
    spark = forecasts.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    due = (F.col(ts) + F.expr(f"INTERVAL {step}")).cast("timestamp")
    made = forecasts.withColumn("_due", due).withWatermark("_due", wait)
    came = actuals.select(
        # never NULL, or the join would drop the horizon row before the watermark sees it
        F.coalesce(F.col(panel), F.lit("\0")).alias("_of"),
        F.col(ts).cast("timestamp").alias("_at"),
        F.col(actual).alias("load_actual_mw"),
    ).withWatermark("_at", wait)
    same = (F.col(panel) == F.col("_of")) & (F.col("_due") == F.col("_at"))
    return made.join(came, same, "leftOuter").drop("_due", "_of", "_at")


def stream_messages(results: DataFrame) -> DataFrame:
    return forecast_messages(forecast_errors(results))


def start_sink(
    stream: DataFrame,
    checkpoint: str,
    sink: str = "parquet",
    options: dict[str, str] | None = None,
    available_now: bool = True,
):
    """Start writing a stream in append mode.

    ``sink`` is any streaming format of the session. For ``kafka`` a table of messages
    is sent as key (panel) and value (JSON).
    """
    if sink == "kafka":
        stream = stream.select(
            F.col("panel_id").alias("key"), F.col("message").alias("value")
        )
    writer = (
        stream.writeStream.format(sink)
        .outputMode("append")
        .options(**(options or {}))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drain what the source has into Parquet files, exactly once; returns the table."""
    start_sink(stream, checkpoint, options={"path": path}).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def windowed_batches(
    spec: PanelSpec,
    settings: Settings,
    tails: str,
    out: str,
    rows_per_chunk: int | None = None,
    buckets: int = 256,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: online features by the batch operator itself.

    Each micro-batch is joined with the last rows of its panels, runs through
    ``build_features`` and leaves the new last rows. A panel holding most of a micro-batch
    is cut into chunks like any long group, which keyed state cannot do.

    The last rows lie in ``buckets`` by hash of the panel, each with two slots; a small
    manifest names the newer slot of each bucket. A micro-batch reads and writes only the
    buckets of its panels, into the slot that the manifest before it does not name, so what
    it moves follows the panels it touches, space is at most twice the last rows, and a
    repeated batch finds what it found before and overwrites itself.
    """

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        need = history_rows(settings) + 1
        columns = [spec.panel, "sequence_id", spec.ts, *spec.zones]
        bucket = F.pmod(F.xxhash64(spec.panel), F.lit(buckets)).cast("int")
        fresh = batch.select(*columns)
        slots = {}
        if number > 0:
            manifest = spark.read.schema(MANIFEST).parquet(f"{tails}/manifest={(number - 1) % 2}")
            slots = {r["bucket"]: r["slot"] for r in manifest.collect()}  # at most ``buckets``
        touched = [r[0] for r in fresh.select(bucket).distinct().collect()]  # likewise
        paths = [f"{tails}/rows/_slot={slots[k]}/_bucket={k}" for k in touched if k in slots]
        tail = fresh.filter("false")
        if paths:
            tail = spark.read.schema(fresh.schema).parquet(*paths)
            newest = tail.groupBy(spec.panel).agg(F.max(spec.ts).alias("_newest"))
            fresh = (
                attach(fresh, newest, [spec.panel])
                .filter(F.col("_newest").isNull() | (F.col(spec.ts) > F.col("_newest")))
                .drop("_newest")
            )
        rows = tail.withColumn("_new", F.lit(False)).unionByName(
            fresh.withColumn("_new", F.lit(True))
        ).persist()
        try:
            made = build_features(
                rows,
                spec,
                settings,
                keep=("sequence_id", *spec.zones, "_new"),
                with_target=False,
                rows_per_chunk=rows_per_chunk,
            )
            made.filter("_new").drop("_new").write.mode("overwrite").parquet(
                f"{out}/batch={number}"
            )
            into = {k: 1 - slots.get(k, 1) for k in touched}
            second = [k for k, slot in into.items() if slot == 1]
            last = latest(rows.drop("_new"), [spec.panel], [spec.ts], need)
            (
                last.withColumn("_bucket", bucket)
                .withColumn("_slot", F.col("_bucket").isin(second).cast("int"))
                .repartition("_bucket")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("_slot", "_bucket")
                .parquet(f"{tails}/rows")
            )
            manifest_of(spark, slots | into).coalesce(1).write.mode("overwrite").parquet(
                f"{tails}/manifest={number % 2}"
            )
        finally:
            rows.unpersist()

    return process


def manifest_of(spark: SparkSession, slots: dict[int, int]) -> DataFrame:
    """The newer slot of each bucket; as an Arrow table it needs no Python worker to be written."""
    table = pa.table({"bucket": pa.array(slots, "int32"), "slot": pa.array(slots.values(), "int32")})
    return spark.createDataFrame(table, MANIFEST)


def run_windowed(
    events: DataFrame,
    spec: PanelSpec,
    settings: Settings,
    work: str,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Drain a stream through ``windowed_batches``; returns the feature table."""
    out = f"{work}/features"
    query = (
        events.writeStream.foreachBatch(
            windowed_batches(spec, settings, f"{work}/tails", out, rows_per_chunk)
        )
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return events.sparkSession.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")
