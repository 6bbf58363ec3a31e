"""Aggregate columns: error metrics and latency percentiles."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

LATENCY_POINTS = (0.5, 0.95, 0.99)
LATENCY_NAMES = ("p50_ms", "p95_ms", "p99_ms")


def _both(actual: Column, predicted: Column) -> Column:
    return actual.isNotNull() & predicted.isNotNull()


def n_samples(actual: Column, predicted: Column) -> Column:
    return F.count_if(_both(actual, predicted))


def mae(actual: Column, predicted: Column) -> Column:
    return F.coalesce(F.avg(F.abs(actual - predicted)), F.lit(0.0))


def rmse(actual: Column, predicted: Column) -> Column:
    miss = actual - predicted
    return F.coalesce(F.sqrt(F.avg(miss * miss)), F.lit(0.0))


def mape(actual: Column, predicted: Column) -> Column:
    """Percent; zero actuals are skipped, only zeros give +inf, no rows give 0."""
    share = F.when(actual != 0, F.abs(F.try_divide(actual - predicted, actual)))
    usable = F.count_if(_both(actual, predicted) & (actual != 0))
    return (
        F.when(n_samples(actual, predicted) == 0, F.lit(0.0))
        .when(usable == 0, F.lit(math.inf))
        .otherwise(F.lit(100.0) * F.avg(share))
    )


def error_metrics(actual: Column, predicted: Column, prefix: str = "") -> list[Column]:
    return [
        mae(actual, predicted).alias(f"{prefix}mae"),
        rmse(actual, predicted).alias(f"{prefix}rmse"),
        mape(actual, predicted).alias(f"{prefix}mape"),
    ]


def sum_terms(actual: Column, predicted: Column, prefix: str) -> dict[str, Column]:
    """Per-row terms whose sums and counts rebuild MAE, RMSE and MAPE anywhere."""
    both = _both(actual, predicted)
    miss = actual - predicted
    return {
        f"{prefix}n": F.when(both, F.lit(1)).otherwise(F.lit(0)).cast("long"),
        f"{prefix}abs": F.coalesce(F.abs(miss), F.lit(0.0)),
        f"{prefix}sq": F.coalesce(miss * miss, F.lit(0.0)),
        f"{prefix}nz": F.when(both & (actual != 0), F.lit(1)).otherwise(F.lit(0)).cast("long"),
        f"{prefix}pct": F.coalesce(
            F.when(actual != 0, F.abs(F.try_divide(miss, actual))), F.lit(0.0)
        ),
    }


def from_terms(prefix: str, out: str) -> list[Column]:
    """MAE, RMSE, MAPE out of summed ``sum_terms`` columns."""
    n, nz = F.col(f"{prefix}n"), F.col(f"{prefix}nz")
    return [
        F.coalesce(F.try_divide(F.col(f"{prefix}abs"), n), F.lit(0.0)).alias(f"{out}mae"),
        F.coalesce(F.sqrt(F.try_divide(F.col(f"{prefix}sq"), n)), F.lit(0.0)).alias(f"{out}rmse"),
        F.when(n == 0, F.lit(0.0))
        .when(nz == 0, F.lit(math.inf))
        .otherwise(F.lit(100.0) * F.try_divide(F.col(f"{prefix}pct"), nz))
        .alias(f"{out}mape"),
    ]
