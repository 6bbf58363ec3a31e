"""Cleaning a panel: keep-last dedup, null drop, clipping, in this order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.functions.expressions import clip_low
from loadweave.settings import PanelSpec
from loadweave.sources.readers import select_required


def dedup_last(
    df: DataFrame, keys: Sequence[str], seq: str, copies: str | None = None
) -> DataFrame:
    """One row per key: the one with the highest ``seq``.

    A hash aggregate that combines map-side, so copies never meet in one task. Every
    column follows the same ``seq``, hence comes from the same row; NULLs count.
    ``copies`` names a column for the number of rows a key had.
    """
    values = [c for c in df.columns if c not in keys and c != seq]
    return df.groupBy(*keys).agg(
        F.max(seq).alias(seq),
        *[F.max_by(c, seq).alias(c) for c in values],
        *([F.count(F.lit(1)).alias(copies)] if copies else []),
    )


def drop_incomplete(df: DataFrame, zones: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(zones))


def clip_negative(df: DataFrame, zones: Sequence[str]) -> DataFrame:
    return df.withColumns({z: clip_low(F.col(z)) for z in zones})


def clean(df: DataFrame, spec: PanelSpec, seq: str = "ingest_seq") -> DataFrame:
    """Required columns, last copy of each timestamp, complete rows, no negatives.

    An hour whose last copy has a NULL zone is lost: dedup comes before the drop.
    """
    rows = select_required(df, [*spec.keys, seq, spec.ts, *spec.zones])
    rows = dedup_last(rows, [*spec.keys, spec.ts], seq)
    return clip_negative(drop_incomplete(rows, spec.zones), spec.zones).drop(seq)
