"""Command line, for spark-submit or ``python -m loadweave``.

train     read a CSV, clean it, fit on the first part, save model and report
evaluate  score the saved model on the last part, write the report
stream    replay the last part as a stream: forecasts, messages, snapshots, report

The CSV path, columns, ratios and so on come from ``LOADWEAVE_*`` variables.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.operators import cleaning, evaluation, forecasting, quality, splits
from loadweave.session import configure, scratch_path
from loadweave.settings import PanelSpec, Settings
from loadweave.sources import readers, sinks
from loadweave.streaming import flows


def load_clean(spark: SparkSession, settings: Settings) -> tuple[DataFrame, PanelSpec]:
    """The cleaned panel, written once: every later step reads it back."""
    spec = PanelSpec.from_settings(settings)
    raw = readers.read_panel_csv(spark, settings.data_path, settings)
    path = scratch_path(spark, "clean-panel")
    cleaning.clean(raw, spec).write.parquet(path)
    return spark.read.parquet(path), spec


def report_quality(spark: SparkSession, settings: Settings, out: str) -> None:
    spec = PanelSpec.from_settings(settings)
    raw = readers.read_panel_csv(spark, settings.data_path, settings)
    kept, _ = load_clean(spark, settings)
    sinks.write_report(quality.quality_counts(raw, spec), f"{out}/quality_counts")
    sinks.write_report(quality.outlier_report(kept, spec), f"{out}/outliers")
    sinks.write_report(quality.gap_report(kept, spec), f"{out}/gaps")
    sinks.write_report(quality.panel_summary(kept, spec), f"{out}/summary")


def train(spark: SparkSession, settings: Settings, out: str) -> None:
    panel, spec = load_clean(spark, settings)
    trained, baselines = forecasting.train(panel, spec, settings)
    sinks.save_model(trained.model, settings.model_path)
    report = forecasting.training_report(spark, trained, baselines, settings.model_path)
    sinks.write_report(report, f"{out}/training_report")


def evaluate(spark: SparkSession, settings: Settings, out: str) -> None:
    panel, spec = load_clean(spark, settings)
    model = sinks.load_model(spark, settings.model_path)
    held = forecasting.holdout_features(panel, spec, settings)
    series = f"{spec.target}_lag_1"
    results = forecasting.forecast(held, model, spec, settings, carry=(series,))
    report = forecasting.evaluation_report(results, spec, series)
    sinks.write_report(report, f"{out}/evaluation_report")


def stream(spark: SparkSession, settings: Settings, out: str, slices: int) -> None:
    panel, spec = load_clean(spark, settings)
    model = sinks.load_model(spark, settings.model_path)
    parts = splits.chrono_split(panel, spec.keys, [spec.ts], settings.train_ratio)
    events = parts.filter("split = 'stream'").select(
        spec.panel, parts["split_index"].alias("sequence_id"), spec.ts, *spec.zones
    )
    replay = scratch_path(spark, "replay")
    sinks.write_replay(events, replay, slices=slices)
    source = flows.replay_source(spark, replay, flows.event_schema(spec))
    made = flows.online_features(source, spec, settings, mode="label")
    results = flows.run_to_end(
        flows.stream_forecast(made, model, spec, settings),
        f"{out}/forecasts",
        scratch_path(spark, "forecast-checkpoint"),
    )
    errors = evaluation.forecast_errors(results)
    sinks.forecast_messages(errors).write.json(f"{out}/forecast_messages")
    shots = evaluation.cumulative_snapshots(
        results, every=settings.snapshot_every, latency=True
    )
    totals = results.groupBy("panel_id").agg(F.count("*").alias("total_events"))
    shots = shots.join(totals, "panel_id")
    sinks.metrics_messages(shots).write.json(f"{out}/metrics_messages")
    sinks.write_report(evaluation.final_metrics(results), f"{out}/stream_report")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loadweave")
    parser.add_argument("command", choices=("quality", "train", "evaluate", "stream"))
    parser.add_argument("--out", default="artifacts", help="folder for reports and results")
    parser.add_argument("--slices", type=int, default=4, help="micro-batches of a replay")
    args = parser.parse_args(argv)
    spark = configure(SparkSession.builder.appName("loadweave").getOrCreate())
    settings = Settings.from_env()
    if args.command == "quality":
        report_quality(spark, settings, args.out)
    elif args.command == "train":
        train(spark, settings, args.out)
    elif args.command == "evaluate":
        evaluate(spark, settings, args.out)
    else:
        stream(spark, settings, args.out, args.slices)
    return 0


if __name__ == "__main__":
    sys.exit(main())
