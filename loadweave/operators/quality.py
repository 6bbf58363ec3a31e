"""Quality reports beside the cleaning steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.functions.expressions import micros
from loadweave.operators.cleaning import dedup_last, drop_incomplete
from loadweave.plans.joins import attach
from loadweave.plans.layout import lay_out
from loadweave.settings import PanelSpec


def outlier_limits(df: DataFrame, spec: PanelSpec, k: float = 5.0) -> DataFrame:
    """mean + k * sample deviation of every zone, per panel (``<zone>_limit``).

    The limit is NULL with fewer than two rows: then nothing is an outlier.
    """
    return df.groupBy(*spec.keys).agg(
        *[
            (F.avg(z) + F.lit(k) * F.stddev_samp(z)).alias(f"{z}_limit")
            for z in spec.zones
        ]
    )


def outlier_flags(
    df: DataFrame, spec: PanelSpec, k: float = 5.0, n_panels: int | None = None
) -> DataFrame:
    """Flag values strictly above the limit in ``<zone>_outlier``; rows are kept."""
    rows = attach(df, outlier_limits(df, spec, k), spec.keys, n_panels)
    flags = {
        f"{z}_outlier": F.coalesce(F.col(z) > F.col(f"{z}_limit"), F.lit(False))
        for z in spec.zones
    }
    return rows.withColumns(flags).drop(*[f"{z}_limit" for z in spec.zones])


def outlier_report(
    df: DataFrame, spec: PanelSpec, k: float = 5.0, n_panels: int | None = None
) -> DataFrame:
    """One row per panel and zone: limit and number of values above it."""
    limits = outlier_limits(df, spec, k)
    rows = attach(df, limits, spec.keys, n_panels)
    counted = rows.groupBy(*spec.keys).agg(
        *[F.first(f"{z}_limit").alias(f"{z}_limit") for z in spec.zones],
        *[
            F.count_if(F.col(z) > F.col(f"{z}_limit")).alias(f"{z}_n")
            for z in spec.zones
        ],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(z).alias("zone"),
                F.col(f"{z}_limit").alias("threshold"),
                F.col(f"{z}_n").alias("n_outliers"),
            )
            for z in spec.zones
        ]
    )
    return counted.select(*spec.keys, F.inline(cells))


def with_gap(df: DataFrame, spec: PanelSpec, max_rows: int | None = None) -> DataFrame:
    """Hours to the previous row of the panel (NULL on the first)."""
    layout = lay_out(df, spec.keys, [spec.ts], back=1, max_rows=max_rows)
    now = micros(F.col(spec.ts))
    before = F.lag(now, 1).over(layout.window)
    return layout.core(
        layout.df.withColumn("gap_hours", (now - before).cast("double") / F.lit(3.6e9))
    )


def gap_report(
    df: DataFrame, spec: PanelSpec, step_hours: float = 1.0, max_rows: int | None = None
) -> DataFrame:
    """Gaps of more than one step and of more than three, and the longest in hours."""
    gap = F.col("gap_hours")
    return (
        with_gap(df.select(*spec.keys, spec.ts), spec, max_rows)
        .groupBy(*spec.keys)
        .agg(
            F.count_if(gap > F.lit(step_hours)).alias("gaps"),
            F.count_if(gap > F.lit(3.0 * step_hours)).alias("large_gaps"),
            F.max(gap).alias("longest_gap_hours"),
        )
    )


def panel_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(spec.ts).alias("first_ts"),
        F.max(spec.ts).alias("last_ts"),
    )


def quality_counts(df: DataFrame, spec: PanelSpec, seq: str = "ingest_seq") -> DataFrame:
    """Duplicates, incomplete rows and negatives per zone, as (check, zone, n).

    Each count is taken where its cleaning step acts: duplicates on the raw rows,
    incomplete rows after dedup, negatives after the null drop. The input is read once.
    """
    numbered = df.select(*spec.keys, spec.ts, seq, *spec.zones)
    kept = dedup_last(numbered, [*spec.keys, spec.ts], seq, copies="_copies")
    complete = F.lit(True)
    for z in spec.zones:
        complete = complete & F.col(z).isNotNull()
    counted = kept.groupBy(*spec.keys).agg(
        F.sum(F.col("_copies") - F.lit(1)).alias("_again"),
        F.count_if(~complete).alias("_incomplete"),
        *[F.count_if(complete & (F.col(z) < 0)).alias(f"_neg_{z}") for z in spec.zones],
    )
    cells = [
        F.struct(
            F.lit("duplicate_ts").alias("check"),
            F.lit("*").alias("zone"),
            F.col("_again").alias("n"),
        ),
        F.struct(
            F.lit("incomplete").alias("check"),
            F.lit("*").alias("zone"),
            F.col("_incomplete").alias("n"),
        ),
    ] + [
        F.struct(
            F.lit("negative").alias("check"),
            F.lit(z).alias("zone"),
            F.col(f"_neg_{z}").alias("n"),
        )
        for z in spec.zones
    ]
    return counted.select(*spec.keys, F.inline(F.array(*cells)))


__all__ = [
    "drop_incomplete",
    "gap_report",
    "outlier_flags",
    "outlier_limits",
    "outlier_report",
    "panel_summary",
    "quality_counts",
    "with_gap",
]
