"""Reading panels: CSV, Parquet tables and long event tables."""

from __future__ import annotations

import csv
import functools
import re
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweave.functions.expressions import micros, nan_to_null
from loadweave.plans.joins import attach
from loadweave.plans.layout import lay_out, spread
from loadweave.settings import PanelSpec, Settings

LOCAL_ROOT = "^file:/+"
GRAINS = {"day": 86_400_000_000, "hour": 3_600_000_000}


class MissingColumns(ValueError):
    """Raised when a panel lacks required columns."""


def select_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep exactly ``columns``; name all that are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"the panel lacks the columns {missing}")
    return df.select(*columns)


def parse_ts(col: Column) -> Column:
    """Text to a zone-free timestamp; text that is no timestamp is an error."""
    return F.to_timestamp_ntz(col)


def read_panel_csv(
    spark: SparkSession,
    path: str,
    settings: Settings = Settings(),
    panel_id: str = "all",
) -> DataFrame:
    """Header CSV files of hourly zone loads as a panel: panel_id, ingest_seq, ts, zones.

    Only the timestamp and zone columns are kept, in lower case. Files may have their columns
    in different orders and different columns besides: files with the same header are scanned
    together, each by its own names. A missing path is an error, and so is a file that lacks a
    column. ``ingest_seq`` orders rows by file name, block and position in the block (not by
    the order in which tasks read them) and decides which duplicate is the last; it is one
    number of fixed width, so deduplication stays a hash aggregate.
    """
    wanted = {settings.datetime_col: T.StringType()} | {
        zone: T.DoubleType() for zone in settings.zones
    }
    groups = _by_header(spark, path)
    for names, files in groups.items():
        missing = [c for c in wanted if c not in names]
        if missing:
            raise MissingColumns(f"the panel lacks the columns {missing} in {files[0]}")
    ranks = {f: i for i, f in enumerate(sorted(f for files in groups.values() for f in files))}
    # the two places that name a file write a local one's root differently
    named = [(re.sub(LOCAL_ROOT, "file:/", f), i) for f, i in ranks.items()]
    ranked = spark.createDataFrame(named, "_file string, _rank long")
    parts = []
    for names, files in groups.items():
        schema = T.StructType([T.StructField(n, wanted.get(n, T.StringType())) for n in names])
        raw = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .csv([unquote(f) for f in files])
        )
        parts.append(
            raw.select(
                *wanted,
                F.regexp_replace("_metadata.file_path", LOCAL_ROOT, "file:/").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)).alias("_row"),
            )
        )
    rows = functools.reduce(DataFrame.unionByName, parts)
    rows = attach(rows, ranked, ["_file"], len(ranks))
    wide = "decimal(38,0)"
    place = F.expr(
        f"cast(cast(_rank as {wide}) * {10**26}BD + _block * {10**10}BD + _row as {wide})"
    )
    return rows.select(
        F.lit(panel_id).alias("panel_id"),
        place.alias("ingest_seq"),
        parse_ts(F.col(settings.datetime_col)).alias("ts"),
        *[nan_to_null(F.col(zone)).alias(zone.lower()) for zone in settings.zones],
    )


def _by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their header; of each only the first line is fetched."""
    try:
        files = spark.read.text(path).inputFiles()
    except AnalysisException as error:
        raise FileNotFoundError(f"no readable CSV at {path}") from error

    def header(file: str) -> tuple[str, ...]:
        first = spark.read.text(unquote(file)).head(1)
        return tuple(next(csv.reader([first[0]["value"]]))) if first else ()

    with ThreadPool(8) as pool:
        names = pool.map(inheritable_thread_target(spark)(header), files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, found in zip(files, names):
        if found:  # a file without a line has no rows
            groups.setdefault(found, []).append(file)
    if not groups:
        raise FileNotFoundError(f"no readable CSV at {path}")
    return groups


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def truncate_ts(ts: Column, grain: str) -> Column:
    """Start of the day or hour of a zone-free timestamp."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    return F.date_trunc(grain, ts).cast("timestamp_ntz")


def panel_from_long(
    df: DataFrame,
    ts: str,
    zone: Column,
    value: str,
    grain: str,
    zones: Sequence[str],
    panel: Column | None = None,
) -> DataFrame:
    """Long rows to one wide row per (panel, step); a zone without rows is NULL.

    One hash aggregate with conditional sums: a single shuffle, summed map-side first.
    """
    keyed = df.select(
        (F.lit("all") if panel is None else panel).alias("panel_id"),
        truncate_ts(F.col(ts), grain).alias("ts"),
        zone.alias("_zone"),
        F.col(value).alias("_value"),
    )
    sums = [F.sum(F.when(F.col("_zone") == z, F.col("_value"))).alias(z.lower()) for z in zones]
    return keyed.groupBy("panel_id", "ts").agg(*sums)


def span(df: DataFrame, ts: str, grain: str) -> tuple[int | None, int]:
    """First step of ``df`` (microseconds) and the number of steps up to its last one.

    One aggregate over one column. The step count bounds the rows of any panel of
    that grain, which is what window layouts ask for.
    """
    step = micros(truncate_ts(F.col(ts), grain))
    low, high = df.agg(F.min(step), F.max(step)).first()
    if low is None:
        return None, 0
    return low, (high - low) // GRAINS[grain] + 1


def densify(
    panel: DataFrame,
    spec: PanelSpec,
    first: int | None,
    steps: int,
    grain: str,
    rows_per_chunk: int | None = None,
    panels: int | None = None,
) -> DataFrame:
    """Every panel on the full calendar; steps or zones without data become 0.0.

    ``first`` and ``steps`` are the calendar (see ``span``) and rows lie on its steps, so
    every panel gets exactly ``steps`` rows. Each row fills the calendar up to the next one, the first row of a
    panel also the time before it: no calendar table is joined, and the filled rows
    stay where their panel is, so windows over the panel need no further shuffle. ``panels``,
    about how many there are, keeps the filled rows of a task from growing with their number.
    """
    if not steps:
        return panel
    if panels is not None:
        panel = spread(panel, spec.keys, panels * steps)
    rows = _stepped(panel, spec, grain, (first, steps), steps, rows_per_chunk)
    own = F.col("_step") == F.col("_at")
    return rows.select(
        spec.panel,
        F.timestamp_micros("_step").cast("timestamp_ntz").alias(spec.ts),
        *[F.coalesce(F.when(own, F.col(z)), F.lit(0.0)).alias(z) for z in spec.zones],
    )


def regularize(
    panel: DataFrame,
    spec: PanelSpec,
    grain: str = "hour",
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Put back the missing steps between the rows of every panel as NULL rows."""
    rows = _stepped(panel, spec, grain, None, max_rows, rows_per_chunk)
    own = F.col("_step") == F.col("_at")
    others = [c for c in panel.columns if c not in (spec.panel, spec.ts)]
    return rows.select(
        spec.panel,
        F.timestamp_micros("_step").cast("timestamp_ntz").alias(spec.ts),
        *[F.when(own, F.col(c)).alias(c) for c in others],
    )


def _stepped(
    panel: DataFrame,
    spec: PanelSpec,
    grain: str,
    calendar: tuple[int, int] | None,
    max_rows: int | None,
    rows_per_chunk: int | None,
) -> DataFrame:
    """Each row repeated for every step up to the next row: its own time is ``_at``, the
    step's ``_step``. With a ``calendar`` (first step, number of steps) also for the
    steps before a panel's first row and after its last one."""
    step = F.lit(GRAINS[grain])
    layout = lay_out(
        panel, spec.keys, [spec.ts], ahead=1, max_rows=max_rows, rows_per_chunk=rows_per_chunk
    )
    at = micros(F.col(spec.ts))
    start, end = at, at
    if calendar is not None:
        first, steps = F.lit(calendar[0]), F.lit(calendar[1] - 1)
        start = F.when(layout.position() == 0, first).otherwise(at)
        end = first + steps * step
    until = F.coalesce(F.lead(at).over(layout.window) - step, end)
    ranged = layout.core(
        layout.df.withColumns({"_at": at, "_from": start, "_to": F.greatest(at, until)})
    )
    return ranged.withColumn("_step", F.explode(F.sequence("_from", "_to", step)))


def series_from_long(
    df: DataFrame, key: str, ts: str, value: str, grain: str
) -> DataFrame:
    """One value series per key: key, ts, sum of value."""
    return (
        df.select(F.col(key).alias("panel_id"), truncate_ts(F.col(ts), grain).alias("ts"), value)
        .groupBy("panel_id", "ts")
        .agg(F.sum(value).alias("v"))
    )

