"""Naive forecasts of the next row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadweave.plans.windows import WindowColumns

BASELINES = ("naive_persistence", "seasonal_naive", "moving_average_24h")
SEASON_ROWS = 168


def naive(series: str, w: WindowColumns) -> Column:
    return w.lag(series, 1)


def seasonal(series: str, w: WindowColumns, rows: int = SEASON_ROWS) -> Column:
    return w.lag(series, rows)


def moving_average(series: str, w: WindowColumns, rows: int = 24) -> Column:
    """Mean of the current row and those before it, NULL until ``rows`` are there."""
    return w.full("mean", series, rows, last=0)


def baseline_columns(
    series: str, w: WindowColumns, convention: str = "shifted"
) -> dict[str, Column]:
    """The three baselines of a series.

    ``shifted``: each shifts the given series as it stands. ``current``: the series is
    already the load at t, so persistence uses it unshifted and the season looks back
    from the row being forecast: L(t), L(t-168), mean L(t..t-23).
    """
    if convention not in ("shifted", "current"):
        raise ValueError("convention must be 'shifted' or 'current'")
    first = naive(series, w) if convention == "shifted" else F.col(series)
    return dict(
        zip(BASELINES, (first, seasonal(series, w), moving_average(series, w)))
    )
