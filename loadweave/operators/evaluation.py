"""Two-stage results, error reports, snapshots, percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadweave.functions import metrics as M
from loadweave.functions.expressions import clip_low, price, price_actual
from loadweave.operators.baselines import BASELINES, baseline_columns
from loadweave.operators.prefix_quantiles import prefix_percentiles
from loadweave.plans.joins import attach
from loadweave.plans.layout import lay_out, running
from loadweave.plans.windows import WindowColumns
from loadweave.session import checkpointed
from loadweave.settings import PanelSpec, Settings


def two_stage(
    df: DataFrame,
    forecast: Column,
    actual: Column,
    sequence: Column,
    latency_ns: Column | None = None,
    settings: Settings = Settings(),
    keep: Sequence[str] = ("panel_id", "ts"),
) -> DataFrame:
    """Forecast load -> price, actual load -> noisy price: one result row per row."""
    staged = df.select(
        *keep,
        sequence.cast("long").alias("sequence_id"),
        clip_low(forecast).alias("load_forecast_mw"),
        actual.alias("load_actual_mw"),
        (F.lit(0) if latency_ns is None else latency_ns).cast("long").alias("latency_ns"),
    )
    return staged.select(
        *keep,
        "sequence_id",
        "load_forecast_mw",
        price(F.col("load_forecast_mw"), settings).alias("price_forecast_usd_mwh"),
        "load_actual_mw",
        price_actual(F.col("load_actual_mw"), F.col("sequence_id"), settings).alias(
            "price_actual_usd_mwh"
        ),
        "latency_ns",
    )


def forecast_errors(results: DataFrame) -> DataFrame:
    return results.withColumns(
        {
            "load_error_mw": F.col("load_forecast_mw") - F.col("load_actual_mw"),
            "price_error_usd_mwh": F.col("price_forecast_usd_mwh")
            - F.col("price_actual_usd_mwh"),
            "inference_latency_ms": F.col("latency_ns") / F.lit(1e6),
        }
    )


def error_table(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    a, p = F.col(actual), F.col(predicted)
    return df.groupBy(*keys).agg(
        *M.error_metrics(a, p), M.n_samples(a, p).alias("n_samples")
    )


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    points: Sequence[float] = M.LATENCY_POINTS,
    names: Sequence[str] = M.LATENCY_NAMES,
    scale: float = 1e6,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated percentiles of a whole-number column per group.

    Counts per distinct value (combined map-side), a running count over the distinct
    values, then the values at the wanted ranks: no group is gathered anywhere.
    """
    counts = checkpointed(
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    )
    layout = lay_out(counts, keys, [value], rows_per_chunk=rows_per_chunk)
    ranked = running(layout, layout.df, {"_upto": "_c"})
    if layout.split:
        totals = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))
        ranked = attach(layout.core(ranked), totals, keys, layout.n_groups)
    else:
        ranked = ranked.withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    found, shown = [], []
    for q, name in zip(points, names):
        exact = F.lit(float(q)) * (F.col("_n") - F.lit(1)).cast("double")
        for end, rank in (("lo", F.floor(exact)), ("hi", F.ceil(exact))):
            here = (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))
            found.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{end}"))
        found.append(F.max(exact - F.floor(exact)).alias(f"_{name}_w"))
        low = F.col(f"_{name}_lo").cast("double")
        high = F.col(f"_{name}_hi").cast("double")
        shown.append(
            ((low + (high - low) * F.col(f"_{name}_w")) / F.lit(scale)).alias(name)
        )
    return ranked.groupBy(*keys).agg(*found).select(*keys, *shown)


def final_metrics(
    results: DataFrame, keys: Sequence[str] = ("panel_id",), rows_per_chunk: int | None = None
) -> DataFrame:
    """Load and price errors, latency percentiles and count over all results."""
    errors = results.groupBy(*keys).agg(
        *M.error_metrics(F.col("load_actual_mw"), F.col("load_forecast_mw"), "load_"),
        *M.error_metrics(
            F.col("price_actual_usd_mwh"), F.col("price_forecast_usd_mwh"), "price_"
        ),
        F.count(F.lit(1)).alias("events_processed"),
    )
    latency = exact_percentiles(results, keys, "latency_ns", rows_per_chunk=rows_per_chunk)
    filled = {n: F.coalesce(F.col(n), F.lit(0.0)) for n in M.LATENCY_NAMES}
    return attach(errors, latency, keys).withColumns(filled)


def metrics_message_struct(snapshot: DataFrame) -> DataFrame:
    """The nested snapshot shape: load_metrics, price_metrics, latency, counters."""

    def group(prefix: str) -> Column:
        return F.struct(*[F.col(f"{prefix}_{m}").alias(m) for m in ("mae", "rmse", "mape")])

    latency = F.struct(*[F.col(n) for n in M.LATENCY_NAMES if n in snapshot.columns])
    keep = [c for c in ("panel_id", "snapshot") if c in snapshot.columns]
    return snapshot.select(
        *keep,
        group("load").alias("load_metrics"),
        group("price").alias("price_metrics"),
        latency.alias("latency"),
        "events_processed",
    )


def cumulative_snapshots(
    results: DataFrame,
    keys: Sequence[str] = ("panel_id",),
    order: Sequence[str] = ("sequence_id",),
    every: int = 24,
    latency: bool = False,
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Errors over results 1..every*k for k = 1, 2, ...; an incomplete tail gives none.

    Rows add up to blocks of ``every`` (map-side), blocks to running sums: MAE, RMSE
    and MAPE are all rebuilt from sums and counts. ``latency`` adds the exact p50/p95/p99 of
    the results so far in milliseconds (0 where none was measured).
    """
    layout = lay_out(results, keys, order, max_rows=max_rows, rows_per_chunk=rows_per_chunk)
    placed = layout.core(layout.df.withColumn("_pos", layout.position()))
    terms = M.sum_terms(F.col("load_actual_mw"), F.col("load_forecast_mw"), "_l")
    terms |= M.sum_terms(F.col("price_actual_usd_mwh"), F.col("price_forecast_usd_mwh"), "_p")
    numbered = placed.withColumns(
        terms | {"snapshot": F.call_function("div", F.col("_pos"), F.lit(every))}
    )
    timed = {"_timed": F.count("latency_ns")} if latency else {}
    blocks = (
        numbered.groupBy(*keys, "snapshot")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(t).alias(t) for t in terms],
            *[c.alias(n) for n, c in timed.items()],
        )
        .filter(F.col("_rows") == every)
    )
    n_blocks = None if max_rows is None else max_rows // every + 1
    if n_blocks is None:  # laying out would run all of the input for its sizes
        blocks = checkpointed(blocks)
    over = lay_out(blocks, keys, ["snapshot"], max_rows=n_blocks, rows_per_chunk=rows_per_chunk)
    sums = over.core(running(over, over.df, {f"_run{t}": t for t in [*terms, *timed]}))
    if latency:
        asked = checkpointed(sums)
        found = prefix_percentiles(
            numbered,
            asked.select(*keys, "snapshot", "_run_timed"),
            keys,
            "snapshot",
            "latency_ns",
            "_run_timed",
            M.LATENCY_POINTS,
            M.LATENCY_NAMES,
            scale=1e6,
            max_rows=n_blocks,
            rows_per_chunk=rows_per_chunk,
        )
        filled = {n: F.coalesce(F.col(n), F.lit(0.0)) for n in M.LATENCY_NAMES}
        sums = attach(asked, found, [*keys, "snapshot"]).withColumns(filled)
    totals = sums.select(
        *keys,
        (F.col("snapshot") + F.lit(1)).cast("long").alias("snapshot"),
        *[F.col(f"_run{t}").alias(t) for t in terms],
        *(M.LATENCY_NAMES if latency else ()),
    )
    return totals.select(
        *keys,
        "snapshot",
        (F.col("snapshot") * F.lit(every)).alias("events_processed"),
        *M.from_terms("_l", "load_"),
        *M.from_terms("_p", "price_"),
        *(M.LATENCY_NAMES if latency else ()),
    )


def rolling_metrics(
    results: DataFrame,
    keys: Sequence[str] = ("panel_id",),
    order: Sequence[str] = ("sequence_id",),
    rows: int = 24,
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Errors over each result and the ``rows - 1`` before it, once so many are there."""
    layout = lay_out(
        results, keys, order, back=rows - 1, max_rows=max_rows, rows_per_chunk=rows_per_chunk
    )
    frame = layout.window.rowsBetween(-(rows - 1), 0)
    terms = M.sum_terms(F.col("load_actual_mw"), F.col("load_forecast_mw"), "_l")
    terms |= M.sum_terms(F.col("price_actual_usd_mwh"), F.col("price_forecast_usd_mwh"), "_p")
    framed = layout.df.withColumns(terms).withColumns(
        {"_rows": F.count(F.lit(1)).over(frame)}
        | {f"_w{t}": F.sum(t).over(frame) for t in terms}
    )
    full = layout.core(framed).filter(F.col("_rows") == rows)
    return full.select(
        *keys, *order, *[F.col(f"_w{t}").alias(t) for t in terms]
    ).select(*keys, *order, *M.from_terms("_l", "load_"), *M.from_terms("_p", "price_"))


def with_baselines(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    series: str,
    convention: str = "shifted",
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    layout = lay_out(df, keys, order, back=168, max_rows=max_rows, rows_per_chunk=rows_per_chunk)
    w = WindowColumns(layout.window)
    made = baseline_columns(series, w, convention)
    rows = layout.core(w.onto(layout.df))
    return rows.select(*df.columns, *[c.alias(n) for n, c in made.items()])


def evaluate_baselines(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    actual: str,
    series: str,
    convention: str = "shifted",
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per group and baseline: errors and the rows they are taken on.

    Each baseline is scored where it and the actual exist, so n_samples differs.
    ``by`` groups the scores; the default is ``keys``, an empty list pools all panels.
    """
    by = keys if by is None else by
    narrow = df.select(*dict.fromkeys([*keys, *order, actual, series]))
    rows = with_baselines(narrow, keys, order, series, convention, max_rows, rows_per_chunk)
    aggregates, cells = [], []
    for name in BASELINES:
        a, p = F.col(actual), F.col(name)
        scored = F.when(p.isNotNull(), a)
        aggregates += M.error_metrics(scored, p, f"{name}_")
        aggregates.append(M.n_samples(a, p).alias(f"{name}_n"))
        cells.append(
            F.struct(
                F.lit(name).alias("baseline"),
                *[F.col(f"{name}_{m}").alias(m) for m in ("mae", "rmse", "mape")],
                F.col(f"{name}_n").alias("n_samples"),
            )
        )
    return rows.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*cells)))


def beats_all(model: DataFrame, baselines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether the model's MAE is strictly below every baseline's, per group."""
    ours = model.select(*keys, F.col("mae").alias("model_mae"))
    return (
        attach(baselines, ours, keys)
        .groupBy(*keys)
        .agg(
            F.first("model_mae").alias("model_mae"),
            F.bool_and(F.col("model_mae") < F.col("mae")).alias("model_beats_all_baselines"),
        )
    )


def fold_averages(folds: DataFrame) -> DataFrame:
    """Mean of the fold errors; the mean best iteration, truncated."""
    return folds.agg(
        F.avg("val_mae").alias("mae"),
        F.avg("val_rmse").alias("rmse"),
        F.avg("val_mape").alias("mape"),
        F.avg("best_iteration").cast("long").alias("average_best_iteration"),
    )


def latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 200
) -> DataFrame:
    """The last ``n`` rows of every group.

    Spark keeps at most ``n`` rows per group and task before the shuffle (window
    group limit), so a hot group never travels whole.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def error_histogram(
    results: DataFrame,
    keys: Sequence[str] = ("panel_id",),
    order: Sequence[str] = ("sequence_id",),
    error: str = "load_error_mw",
    bins: int = 30,
    n: int = 200,
    minimum: int = 10,
) -> DataFrame:
    """Equal-width histogram of the latest ``n`` errors of each group with more than
    ``minimum`` of them; empty bins are not listed, the top edge is in the last bin."""
    recent = latest(results.select(*keys, *order, error), keys, order, n)
    whole = Window.partitionBy(*keys)  # at most n rows
    e = F.col(error)
    ranged = recent.withColumns(
        {
            "_lo": F.min(e).over(whole),
            "_hi": F.max(e).over(whole),
            "_n": F.count(e).over(whole),
        }
    ).filter((F.col("_n") > minimum) & e.isNotNull())
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    bin_no = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(e - F.col("_lo"), width)), F.lit(bins - 1))
    )
    return (
        ranged.withColumns({"bin": bin_no.cast("int"), "_width": width})
        .groupBy(*keys, "bin")
        .agg(
            F.first(F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
            F.first(F.col("_lo") + (F.col("bin") + F.lit(1)) * F.col("_width")).alias("bin_end"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def replay_status(
    events: DataFrame,
    as_of: Column,
    keys: Sequence[str] = ("panel_id",),
    ts: str = "ts",
    history: int = 168,
) -> DataFrame:
    """Progress of a replay at logical time ``as_of``, per panel."""
    out = F.count_if(F.col(ts) <= as_of)
    total = F.count(F.lit(1))
    return events.groupBy(*keys).agg(
        F.max(F.when(F.col(ts) <= as_of, F.col(ts))).alias("logical_time"),
        out.alias("events_emitted"),
        (total - out).alias("events_remaining"),
        F.bround(F.lit(100.0) * out / total, 1).alias("progress_pct"),
        (out >= history).alias("buffer_warm"),
    )
