"""Writing panels, replay slices, reports and messages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweave.session import scratch_path
from loadweave.settings import PanelSpec, Settings

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_panel_csv(
    panel: DataFrame, path: str, spec: PanelSpec, settings: Settings = Settings()
) -> None:
    """A panel as header CSV with the configured column names."""
    names = dict(zip(spec.zones, settings.zones))
    panel.select(
        F.date_format(spec.ts, TS_FORMAT).alias(settings.datetime_col),
        *[F.col(z).alias(names[z]) for z in spec.zones],
    ).write.option("header", True).csv(path)


def write_replay(
    events: DataFrame,
    path: str,
    order: str = "sequence_id",
    slices: int = 4,
    panel: str = "panel_id",
    end_marks: bool = False,
) -> int:
    """Events as ``slices`` sets of Parquet files, written one after the other in order.

    A file stream reads files by modification time. Within a slice a panel's rows are
    in one file, and slices follow each other, so every panel is replayed in order
    whatever the number of files per micro-batch. Take more slices for more rows: a
    panel's share of a slice is written by one task. Returns the number of files.

    ``end_marks`` adds a last set of files with one row per panel in which all else is NULL:
    the end of a bounded replay.

    ``events`` are evaluated once and dealt to one folder per slice in one pass; each
    slice is then written from its own folder, so reading does not grow with ``slices``.
    """
    spark = events.sparkSession
    once, dealt = scratch_path(spark, "replay-events"), scratch_path(spark, "replay-dealt")
    events.write.parquet(once)
    kept = spark.read.schema(events.schema).parquet(once)
    low, high = kept.agg(F.min(order), F.max(order)).first()
    if low is None:
        kept.write.mode("append").parquet(path)
    else:
        number = F.call_function("div", F.col(order) - F.lit(low), F.lit((high - low) // slices + 1))
        kept.withColumn("_slice", number.cast("long")).write.partitionBy("_slice").parquet(dealt)
        schema = T.StructType([*events.schema.fields, T.StructField("_slice", T.LongType())])
        for i in range(slices):
            part = spark.read.schema(schema).parquet(dealt).filter(F.col("_slice") == i)
            part = part.drop("_slice").repartition(panel).sortWithinPartitions(order)
            part.write.mode("append").parquet(path)
    if end_marks:
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name != panel]
        marks = kept.select(panel).distinct().select(panel, *blank).select(*events.columns)
        marks.write.mode("append").parquet(path)
    return len(spark.read.parquet(path).inputFiles())


def write_horizon(spark: SparkSession, path: str, schema: T.StructType, until, ts: str = "ts") -> None:
    """Ends a bounded replay for watermarks: one last row that has nothing but a time."""
    cells = [F.lit(until if f.name == ts else None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*cells).write.mode("append").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A small report as JSON lines."""
    report.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """A saved model; a missing one is an error."""
    try:
        spark.read.text(f"{path.rstrip('/')}/metadata")
    except AnalysisException as error:
        raise FileNotFoundError(f"no saved model at {path}") from error
    return PipelineModel.load(path)


def iso_ts(ts: Column) -> Column:
    """ISO 8601; a fraction is shown, with six digits, only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(exact.endswith(".000000"), whole).otherwise(exact)


def forecast_messages(errors: DataFrame, keep: tuple[str, ...] = ("panel_id",)) -> DataFrame:
    """One JSON message per result row with errors."""
    body = F.struct(
        F.lit("forecast").alias("type"),
        "sequence_id",
        iso_ts(F.col("ts")).alias("logical_timestamp"),
        "load_actual_mw",
        "load_forecast_mw",
        "load_error_mw",
        "price_actual_usd_mwh",
        "price_forecast_usd_mwh",
        "price_error_usd_mwh",
        "inference_latency_ms",
    )
    return errors.select(*keep, F.to_json(body).alias("message"))


FORECAST_SCHEMA = (
    "type string, sequence_id long, logical_timestamp string, load_actual_mw double, "
    "load_forecast_mw double, load_error_mw double, price_actual_usd_mwh double, "
    "price_forecast_usd_mwh double, price_error_usd_mwh double, inference_latency_ms double"
)

METRICS_SCHEMA = (
    "type string, window string, load_mae double, load_rmse double, load_mape double, "
    "price_mae double, price_rmse double, price_mape double, events_processed long"
)


def metrics_messages(snapshots: DataFrame, keep: tuple[str, ...] = ("panel_id",)) -> DataFrame:
    """One JSON message per snapshot; the window label says what the numbers are.

    A ``total_events`` column of the snapshots (the length of a bounded replay) is passed on.
    """
    latency = [c for c in ("p99_ms",) if c in snapshots.columns]
    body = F.struct(
        F.lit("metrics_update").alias("type"),
        F.lit("cumulative").alias("window"),
        "load_mae",
        "load_rmse",
        "load_mape",
        "price_mae",
        "price_rmse",
        "price_mape",
        "events_processed",
        *[F.col(c) for c in ("total_events",) if c in snapshots.columns],
        *[F.col(c).alias(f"latency_{c}") for c in latency],
    )
    return snapshots.select(*keep, F.to_json(body).alias("message"))


def parse_messages(messages: DataFrame, schema: str, keep: tuple[str, ...] = ("panel_id",)) -> DataFrame:
    parsed = messages.select(*keep, F.from_json("message", schema).alias("m"))
    return parsed.select(*keep, "m.*")
