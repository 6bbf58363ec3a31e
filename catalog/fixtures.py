"""Panels, series, logs and requests derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadweave.functions.expressions import micros
from loadweave.settings import PanelSpec
from loadweave.sources.readers import (
    densify,
    panel_from_long,
    read_table,
    series_from_long,
    span,
)

DAILY = PanelSpec(target="af", others=("ao", "nf", "no", "rf", "ro"))
DAILY_ZONES = ("AF", "AO", "NF", "NO", "RF", "RO")
HOURLY_ZONES = ("click", "error", "purchase", "signup", "view")
HOURLY = PanelSpec(target="click", others=("error", "purchase", "signup", "view"))


def six(name: str) -> Column:
    """``F.round(name, 6)``, without its decimal of every value: only what lies near the middle of
    two results, is large or no number takes that way; the others are whole millionths over 1e6."""
    value = F.col(name)
    places = value * F.lit(1e6)
    plain = (F.abs(places - F.rint(places)) < 0.499) & (F.abs(places) < 1e12)
    # + 0.0: no negative zero, as decimals have none
    return F.when(plain, F.rint(places) / F.lit(1e6) + F.lit(0.0)).otherwise(F.round(value, 6))


def r6(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, for comparison across engines."""
    return df.select(*[six(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r9(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``r6``, and the named columns (milliseconds, exact to parts of a nanosecond) to nine."""
    kept = {n: F.round(n, 9) for n in names}
    return df.select(
        *[
            kept[c].alias(c) if c in kept else six(c).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def panel_daily_sparse(spark: SparkSession, sf: str) -> DataFrame:
    zone = F.concat("l_returnflag", "l_linestatus")
    return panel_from_long(
        read_table(spark, sf, "lineitem"), "l_shipdate", zone, "l_quantity", "day", DAILY_ZONES
    )


def daily_steps(spark: SparkSession, sf: str) -> tuple[int | None, int]:
    return span(read_table(spark, sf, "lineitem"), "l_shipdate", "day")


def panel_daily(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """The dense daily panel and its number of rows per panel."""
    first, steps = daily_steps(spark, sf)
    sparse = panel_daily_sparse(spark, sf)
    return densify(sparse, DAILY, first, steps, "day"), steps


def panel_hourly_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return panel_from_long(
        read_table(spark, sf, "events"), "ts", F.col("event_type"), "value", "hour", HOURLY_ZONES
    )


def series_supplier(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """Daily quantity per supplier, and the bound on rows per series (calendar days)."""
    _, steps = daily_steps(spark, sf)
    lineitem = read_table(spark, sf, "lineitem")
    return series_from_long(lineitem, "l_suppkey", "l_shipdate", "l_quantity", "day"), steps


def day_number(ts: Column) -> Column:
    return F.call_function("div", micros(ts), F.lit(86_400_000_000))


def raw_dirty(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """The dense panel with faults placed by day number: missing days, NULLs,
    negatives, spikes, and second copies of a day, some of them incomplete."""
    panel, steps = panel_daily(spark, sf)
    d = F.col("_d")
    base = panel.withColumn("_d", day_number(F.col("ts"))).filter(d % 97 != 5)
    faulty = base.withColumns(
        {
            "ao": F.when(d % 41 == 3, F.lit(None)).otherwise(F.col("ao")),
            "nf": F.when(d % 53 == 7, F.lit(-1.0) - F.col("nf")).otherwise(F.col("nf")),
            "ro": F.when(d % 211 == 11, F.col("ro") * 100 + 10000).otherwise(F.col("ro")),
            "_copy": F.explode(
                F.when(d % 29 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
            ),
        }
    )
    copies = {z: F.col(z) + F.col("_copy").cast("double") for z in DAILY.zones}
    copies["af"] = F.when(
        (F.col("_copy") == 1) & (d % 58 == 1), F.lit(None)
    ).otherwise(copies["af"])
    out = faulty.withColumns(copies).withColumn("ingest_seq", d * 10 + F.col("_copy"))
    return out.select("panel_id", "ingest_seq", "ts", *DAILY.zones), steps


def indexed_daily(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """The dense panel as replay events: ``sequence_id`` counts the days."""
    first, _ = daily_steps(spark, sf)
    panel, steps = panel_daily(spark, sf)
    start = (first or 0) // 86_400_000_000
    return panel.withColumn("sequence_id", day_number(F.col("ts")) - F.lit(start)), steps


def latency_stand_in(sequence: Column) -> Column:
    return F.lit(100_000) + (sequence * F.lit(7919)) % F.lit(50_000)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every day with 168 values up to and including it asks with these; every 7th request is
    one short."""
    events, steps = indexed_daily(spark, sf)
    w = Window.partitionBy("panel_id").orderBy("ts").rowsBetween(-167, 0)  # <= steps rows
    taken = events.select(
        F.col("sequence_id").alias("_s"),
        "ts",
        *[F.collect_list(z).over(w).alias(z) for z in DAILY.zones],
    ).filter(F.col("_s") >= 167)
    request_id = F.col("_s") - 167
    short = F.col("request_id") % 7 == 3
    return taken.withColumn("request_id", request_id).select(
        "request_id",
        "ts",
        *[
            F.when(short & F.lit(z == "nf"), F.slice(z, 1, 167)).otherwise(F.col(z)).alias(z)
            for z in DAILY.zones
        ],
    )


def arrivals(events: DataFrame) -> DataFrame:
    """Replay events as they arrive: up to five places out of order, one in 97 far too late,
    one in 50 delivered twice, one in 100 again after 200 others."""
    s = F.col("sequence_id")
    very_late = F.when(s % 97 == 13, F.lit(1000)).otherwise(F.lit(0))
    lag = F.array_compact(
        F.array(
            F.lit(0), F.when(s % 50 == 7, F.lit(2)), F.when(s % 100 == 3, F.lit(200))
        )
    )
    again = events.withColumn("_lag", F.explode(lag))
    came = (F.col("_lag") + s + (s * 7919) % 6 + very_late).cast("long")
    return again.withColumn("arrival", came).drop("_lag")


def events_supplier(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """The suppliers' panels as replay events, numbered by day."""
    panel, steps = panel_supplier(spark, sf)
    return panel.withColumn("sequence_id", day_number(F.col("ts"))), steps


def panel_supplier(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """One dense daily panel of six zones per supplier: panels grow with the data."""
    first, steps = daily_steps(spark, sf)
    zone = F.concat("l_returnflag", "l_linestatus")
    lineitem = read_table(spark, sf, "lineitem")
    panels = lineitem.agg(F.approx_count_distinct("l_suppkey")).first()[0]
    sparse = panel_from_long(
        lineitem,
        "l_shipdate",
        zone,
        "l_quantity",
        "day",
        DAILY_ZONES,
        panel=F.col("l_suppkey").cast("string"),
    )
    return densify(sparse, DAILY, first, steps, "day", panels=panels), steps


def requests_supplier(spark: SparkSession, sf: str) -> DataFrame:
    """On the first of every month every supplier with 169 days of history asks with these;
    every 7th request lacks a zone's last value.

    A supplier's days lie once in one array (at most the days of the calendar), of which every
    request takes a slice: no frame of 169 rows is gathered for the days that do not ask.
    """
    events, _ = events_supplier(spark, sf)
    day = F.struct("ts", "sequence_id", *DAILY.zones)
    days = events.groupBy("panel_id").agg(F.sort_array(F.collect_list(day)).alias("_days"))
    asking = F.filter(
        F.sequence(F.lit(169), F.size("_days")),
        lambda n: F.dayofmonth(F.element_at("_days", n)["ts"]) == 1,
    )

    def asked(n: Column) -> Column:
        now, past = F.element_at("_days", n), F.slice("_days", n - F.lit(168), 169)
        lists = [past[z].alias(z) for z in DAILY.zones]
        return F.struct(now["sequence_id"].alias("sequence_id"), now["ts"].alias("ts"), *lists)

    taken = days.filter(F.size("_days") >= 169).select(
        "panel_id", F.inline(F.transform(asking, asked))
    )
    request_id = F.col("panel_id").cast("long") * 100_000 + F.col("sequence_id")
    short = F.col("request_id") % 7 == 3
    return taken.withColumn("request_id", request_id).select(
        "request_id",
        "ts",
        *[
            F.when(short & F.lit(z == "nf"), F.slice(z, 1, 168)).otherwise(F.col(z)).alias(z)
            for z in DAILY.zones
        ],
    )
