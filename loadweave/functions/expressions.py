"""Column expressions: price curve, noise, calendar, ratios, presentation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadweave.settings import Settings

RATIO_POLICIES = ("ieee", "fallback", "null")


def nan_to_null(col: Column) -> Column:
    """Missing is NULL everywhere after ingest; NaN is a value to Spark."""
    return F.when(~F.isnan(col), col)


def clip_low(col: Column, floor: float = 0.0) -> Column:
    """Negative values to ``floor``; NULL stays NULL."""
    return F.when(col < F.lit(floor), F.lit(floor)).otherwise(col)


def ratio(num: Column, den: Column, policy: str = "fallback", fallback: float = 1.0) -> Column:
    """``num / den`` with the zero denominator spelled out.

    ieee: x/0 is +-inf and 0/0 is missing. fallback: a fixed value. null: missing.
    """
    if policy not in RATIO_POLICIES:
        raise ValueError(f"unknown ratio policy {policy!r}, use one of {RATIO_POLICIES}")
    quotient = F.when(den != 0, F.try_divide(num, den))
    if policy == "fallback":
        return quotient.when((den == 0) & num.isNotNull(), F.lit(float(fallback)))
    if policy == "ieee":
        return quotient.when((den == 0) & (num > 0), F.lit(math.inf)).when(
            (den == 0) & (num < 0), F.lit(-math.inf)
        )
    return quotient


def price(load: Column, settings: Settings = Settings()) -> Column:
    """Quadratic cost curve a + b L + c L^2."""
    return (
        F.lit(settings.price_intercept)
        + F.lit(settings.price_linear) * load
        + F.lit(settings.price_quadratic) * (load * load)
    )


def standard_normal(key: Column, seed: int) -> Column:
    """N(0, 1) as a function of a row's own key.

    Box-Muller over two hash uniforms: the same row gets the same noise whatever
    the partitioning, on a retry and in a stream.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("double")
    u1 = (high + F.lit(1.0)) / F.lit(4294967297.0)
    u2 = low / F.lit(4294967296.0)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def price_actual(load: Column, key: Column, settings: Settings = Settings()) -> Column:
    """Ground-truth price: the curve plus keyed gaussian noise."""
    noise = standard_normal(key, settings.noise_seed) * F.lit(settings.price_noise_sd)
    return price(load, settings) + noise


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2.0 * math.pi) * value.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar(ts: Column) -> dict[str, Column]:
    """Calendar numbers and their circle positions; Monday is 0, month starts at 1."""
    hour, dow, month = F.hour(ts), F.weekday(ts), F.month(ts)
    hour_sin, hour_cos = cyclic(hour, 24)
    dow_sin, dow_cos = cyclic(dow, 7)
    month_sin, month_cos = cyclic(month, 12)
    numbers = {
        "hour_of_day": hour,
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "day_of_week": dow,
        "dow_sin": dow_sin,
        "dow_cos": dow_cos,
        "month": month,
        "month_sin": month_sin,
        "month_cos": month_cos,
        "is_weekend": (dow >= 5).cast("int"),
        "day_of_year": F.dayofyear(ts),
    }
    return {name: col.cast("double") for name, col in numbers.items()}


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp (session zone is UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def present(forecast: Column, latency_ns: Column, settings: Settings = Settings()) -> dict[str, Column]:
    """Rounded answer fields; the price comes from the unrounded load."""
    return {
        "load_forecast_mw": F.bround(forecast, 1),
        "price_forecast_usd_mwh": F.bround(price(forecast, settings), 2),
        "inference_latency_ms": F.bround(latency_ns.cast("double") / F.lit(1e6), 2),
    }
