"""Token-bucket release times in closed form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.functions.expressions import micros
from loadweave.plans.layout import lay_out, running
from loadweave.settings import Settings


def release_schedule(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    capacity: float = Settings.bucket_capacity,
    rate: float = Settings.bucket_refill_rate,
    cost: str | None = None,
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Earliest time each event may leave a bucket of ``capacity`` refilled at ``rate``/s.

    With P the cost before event k and S the cost through event i,
    s_i = max(t_i, max over k <= i of (t_k - P_k / rate) + (S_i - capacity) / rate).
    Events wait in (ts, tie) order. Adds ``wait_s`` and ``release_ts``.
    """
    if capacity <= 0 or rate <= 0:
        raise ValueError("capacity and rate must be positive")
    if cost is not None:
        too_big = F.col(cost) > F.lit(float(capacity))
        message = F.concat(F.lit("cost above bucket capacity: "), F.col(cost).cast("string"))
        df = df.withColumn(
            cost, F.when(too_big, F.raise_error(message).cast("double")).otherwise(F.col(cost))
        )
    layout = lay_out(df, keys, [ts, tie], max_rows=max_rows, rows_per_chunk=rows_per_chunk)
    if cost is None:
        rows = layout.df.withColumn("_through", (layout.position() + F.lit(1)).cast("double"))
        spent = F.lit(1.0)
    else:
        rows = layout.df.withColumn("_cost", F.col(cost).cast("double"))
        rows = running(layout, rows, {"_through": "_cost"}).drop("_cost")
        spent = F.col(cost).cast("double")
    # Times as microseconds: exact in a double for any date.
    pace = F.lit(1e6 / rate)
    now = micros(F.col(ts)).cast("double")
    rows = rows.withColumn("_slack", now - (F.col("_through") - spent) * pace)
    rows = layout.core(running(layout, rows, {"_top": "_slack"}, "max"))
    leave = F.greatest(
        now, F.col("_top") + (F.col("_through") - F.lit(float(capacity))) * pace
    )
    return rows.select(
        *df.columns,
        ((leave - now) / F.lit(1e6)).alias("wait_s"),
        F.timestamp_micros(F.round(leave).cast("long")).cast("timestamp_ntz").alias("release_ts"),
    )
