"""The feature matrix: one definition for batch, requests and streams.

All features are window expressions over one (panel, ts) order, so Spark sorts once
and evaluates them in window operators on top of a single shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweave.functions.expressions import calendar, ratio
from loadweave.plans.joins import attach
from loadweave.plans.layout import Layout, lay_out
from loadweave.plans.windows import WindowColumns
from loadweave.session import checkpointed, ship_package
from loadweave.settings import PanelSpec, Settings

CALENDAR_NAMES = (
    "hour_of_day",
    "hour_sin",
    "hour_cos",
    "day_of_week",
    "dow_sin",
    "dow_cos",
    "month",
    "month_sin",
    "month_cos",
    "is_weekend",
    "day_of_year",
)


def feature_names(spec: PanelSpec, settings: Settings = Settings()) -> list[str]:
    """Feature columns in their fixed order."""
    t = spec.target
    names = [f"{t}_lag_{k}" for k in settings.target_lags]
    names += [f"{z}_lag_{k}" for z in spec.others for k in settings.cross_lags]
    for n in settings.target_windows:
        names += [f"{t}_roll_mean_{n}h", f"{t}_roll_std_{n}h"]
    names += [f"{t}_roll_min_24h", f"{t}_roll_max_24h"]
    names += [f"{z}_roll_mean_{n}h" for z in spec.others for n in settings.cross_windows]
    names += CALENDAR_NAMES
    names += [f"{t}_diff_1h", f"{t}_diff_24h", f"{t}_ratio_24h"]
    names += [f"{t}_to_{spec.others[0]}_ratio", f"{t}_to_total_ratio"]
    return names


def lags(name: str, ks: Iterable[int], w: WindowColumns, shift: int = 0) -> dict[str, Column]:
    """Row lags; ``shift`` moves all of them towards the present."""
    return {f"{name}_lag_{k}": w.lag(name, k - shift) for k in ks}


def trailing(
    name: str, n: int, w: WindowColumns, stats: Sequence[str], rows: int | None = None
) -> dict[str, Column]:
    """Statistics of the ``n`` rows before the current one, NULL until all are there.

    ``rows`` narrows the frame without renaming the columns.
    """
    return {f"{name}_roll_{stat}_{n}h": w.full(stat, name, rows or n) for stat in stats}


def diffs(name: str, w: WindowColumns) -> dict[str, Column]:
    return {f"{name}_diff_{k}h": F.col(name) - w.lag(name, k) for k in (1, 24)}


def ratios(spec: PanelSpec, w: WindowColumns, policy: str = "fallback") -> dict[str, Column]:
    """Share of a day ago, of the first other zone, and of the total."""
    t = F.col(spec.target)
    total = F.col(spec.zones[0])
    for z in spec.zones[1:]:
        total = total + F.col(z)
    first = spec.others[0]
    return {
        f"{spec.target}_ratio_24h": ratio(t, w.lag(spec.target, 24), policy, 1.0),
        f"{spec.target}_to_{first}_ratio": ratio(t, F.col(first), policy, 1.0),
        f"{spec.target}_to_total_ratio": ratio(t, total, policy, 0.0),
    }


def feature_columns(
    spec: PanelSpec,
    w: WindowColumns,
    settings: Settings = Settings(),
    policy: str = "fallback",
    convention: str = "parity",
) -> dict[str, Column]:
    """Every feature as a column expression over ``w``, in the fixed order.

    ``convention="parity"``: features of row t as in training. ``"online_compat"``:
    the serving buffer of 168 rows that already holds row t, so every lag is one row
    younger and the longest trailing window is one row short.
    """
    if convention not in ("parity", "online_compat"):
        raise ValueError("convention must be 'parity' or 'online_compat'")
    compat = convention == "online_compat"
    shift = 1 if compat else 0
    t = spec.target
    cols: dict[str, Column] = {}
    cols |= lags(t, settings.target_lags, w, shift)
    for z in spec.others:
        cols |= lags(z, settings.cross_lags, w, shift)
    for n in settings.target_windows:
        rows = min(n, settings.history_rows - 1) if compat else n
        cols |= trailing(t, n, w, ("mean", "std"), rows)
    cols |= trailing(t, 24, w, ("min", "max"))
    for z in spec.others:
        for n in settings.cross_windows:
            cols |= trailing(z, n, w, ("mean",))
    cols |= calendar(F.col(spec.ts))
    cols |= diffs(t, w)
    cols |= ratios(spec, w, "fallback" if compat else policy)
    return {name: cols[name] for name in feature_names(spec, settings)}


def history_rows(settings: Settings = Settings()) -> int:
    """Rows before the current one that features can reach."""
    return max(
        *settings.target_lags,
        *settings.cross_lags,
        *settings.target_windows,
        *settings.cross_windows,
        24,
    )


def panel_layout(
    df: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> Layout:
    return lay_out(
        df,
        spec.keys,
        [spec.ts],
        back=history_rows(settings),
        ahead=1,
        max_rows=max_rows,
        rows_per_chunk=rows_per_chunk,
    )


def telling_columns(spec: PanelSpec, settings: Settings = Settings()) -> list[str]:
    """Features that are known only if every feature is.

    The longest trailing mean of a zone is known only if all rows it covers are, so
    shorter windows and the lags inside it need no look; the difference and the ratios
    answer for the current values and for the ratio policy.
    """
    t = spec.target
    longest = max(settings.target_windows)
    names = [f"{t}_roll_mean_{longest}h"]
    names += [f"{t}_lag_{k}" for k in settings.target_lags if k > longest]
    reach = max(settings.cross_windows)
    for z in spec.others:
        names.append(f"{z}_roll_mean_{reach}h")
        names += [f"{z}_lag_{k}" for k in settings.cross_lags if k > reach]
    names += [f"{t}_diff_1h", f"{t}_diff_24h", f"{t}_ratio_24h"]
    return names + [f"{t}_to_{spec.others[0]}_ratio", f"{t}_to_total_ratio"]


def drop_warmup(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only rows on which every named column is known."""
    known = F.lit(True)
    for name in names:
        known = known & F.col(name).isNotNull()
    return df.filter(known)


def _row_columns(
    spec: PanelSpec, settings: Settings, policy: str, with_target: bool
) -> list[Column]:
    """The features in their order over rows that have their history columns."""
    t, first = F.col(spec.target), spec.others[0]
    total = F.col(spec.zones[0])
    for z in spec.zones[1:]:
        total = total + F.col(z)
    cols = calendar(F.col(spec.ts)) | {
        f"{spec.target}_diff_1h": t - F.col("_ago_1"),
        f"{spec.target}_diff_24h": t - F.col("_ago_24"),
        f"{spec.target}_ratio_24h": ratio(t, F.col("_ago_24"), policy, 1.0),
        f"{spec.target}_to_{first}_ratio": ratio(t, F.col(first), policy, 1.0),
        f"{spec.target}_to_total_ratio": ratio(t, total, policy, 0.0),
    }
    shown = [cols.get(n, F.col(f"_h_{n}")).alias(n) for n in feature_names(spec, settings)]
    return shown + ([F.col("_next").alias("target")] if with_target else [])


def _whole_panels(df: DataFrame, spec: PanelSpec, settings: Settings) -> DataFrame:
    """``df`` with its history columns: ``_h_`` and the feature's name, ``_ago_1``, ``_ago_24``,
    ``_next``. One shuffle by panel, then array arithmetic over each panel's rows in time order;
    a value is null where a window expression over the same rows would be."""
    ship_package(df.sparkSession)
    t = spec.target
    lagged = {f"_h_{t}_lag_{k}": (t, k) for k in settings.target_lags}
    lagged |= {f"_h_{z}_lag_{k}": (z, k) for z in spec.others for k in settings.cross_lags}
    lagged |= {"_ago_1": (t, 1), "_ago_24": (t, 24), "_next": (t, -1)}
    framed = {}
    for n in settings.target_windows:
        framed |= {f"_h_{t}_roll_{stat}_{n}h": (t, stat, n) for stat in ("mean", "std")}
    framed |= {f"_h_{t}_roll_{stat}_24h": (t, stat, 24) for stat in ("min", "max")}
    framed |= {f"_h_{z}_roll_mean_{n}h": (z, "mean", n) for z in spec.others for n in settings.cross_windows}
    names, ts, zones = df.columns, spec.ts, spec.zones

    def panel(table: pa.Table) -> pa.Table:
        table = table.sort_by(ts).combine_chunks() if table.num_rows > 1 else table
        values = {z: table[z].fill_null(np.nan).to_numpy() for z in zones}
        unknown = {z: table[z].is_null().to_numpy() for z in zones if table[z].null_count}
        columns = [table[n] for n in names]
        for z, k in lagged.values():
            columns.append(_shifted(values[z], unknown.get(z), k))
        for z, stat, n in framed.values():
            columns.append(_trailing(values[z], unknown.get(z), stat, n))
        return pa.table(columns, names=[*names, *lagged, *framed])

    fields = [T.StructField(n, T.DoubleType()) for n in (*lagged, *framed)]
    schema = T.StructType([*df.schema.fields, *fields])
    return df.groupBy(*spec.keys).applyInArrow(panel, schema)


def _shifted(values: np.ndarray, unknown: np.ndarray | None, k: int) -> pa.Array:
    """The value ``k`` rows before each row, or after it for a negative ``k``; else null."""
    out, null = np.empty(len(values)), np.ones(len(values), dtype=bool)
    into, source = (slice(k, None), slice(None, -k)) if k > 0 else (slice(None, k), slice(-k, None))
    out[into] = values[source]
    null[into] = False if unknown is None else unknown[source]
    return pa.array(out, mask=null)


def _trailing(values: np.ndarray, unknown: np.ndarray | None, stat: str, n: int) -> pa.Array:
    """A statistic of the ``n`` rows before each row, null until all are there and known."""
    out, null = np.empty(len(values)), np.ones(len(values), dtype=bool)
    if len(values) > n:
        past = np.lib.stride_tricks.sliding_window_view(values[:-1], n)
        if stat == "min":  # as in Spark, NaN is above every number
            found = np.fmin.reduce(past, axis=1)
        elif stat == "max":
            found = past.max(axis=1)
        else:
            found = past.mean(axis=1) if stat == "mean" else past.std(axis=1, ddof=1)
        out[n:], null[n:] = found, False
        if unknown is not None:
            null[n:] = np.lib.stride_tricks.sliding_window_view(unknown[:-1], n).any(axis=1)
    return pa.array(out, mask=null)


def build_features(
    df: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    policy: str = "fallback",
    keep: Sequence[str] = (),
    with_target: bool = True,
    drop: bool = True,
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """panel, ts, ``keep``, the features in order, and ``target`` (the next row's load).

    Rows with an unknown feature or target are dropped unless ``drop`` is off. Panels that fit
    one chunk are taken whole, an Arrow table each (``_whole_panels``); long ones are cut, and
    their history columns are window expressions.
    """
    layout = panel_layout(df, spec, settings, max_rows, rows_per_chunk)
    if not layout.split and all(df.schema[z].dataType == T.DoubleType() for z in spec.zones):
        kept = [spec.ts, *dict.fromkeys([*keep, *spec.zones])]
        rows = layout.df.select(*spec.keys, *kept)
        made = _whole_panels(rows, spec, settings).select(
            *spec.keys, spec.ts, *keep, *_row_columns(spec, settings, policy, with_target)
        )
        target = ["target"] if with_target else []
        return drop_warmup(made, telling_columns(spec, settings) + target) if drop else made
    w = WindowColumns(layout.window)
    cols = feature_columns(spec, w, settings, policy)
    telling = telling_columns(spec, settings)
    if with_target:
        cols["target"] = w.lead(spec.target)
        telling.append("target")
    shown = [col.alias(name) for name, col in cols.items()]
    out = layout.core(w.onto(layout.df)).select(*spec.keys, spec.ts, *keep, *shown)
    return drop_warmup(out, telling) if drop else out


def build_interval(
    df: DataFrame,
    spec: PanelSpec,
    start,
    end,
    settings: Settings = Settings(),
    keep: Sequence[str] = (),
    **how,
) -> DataFrame:
    """``build_features`` of the rows from ``start`` to ``end``, without the whole panel.

    A first pass over keys and times finds where each panel's history for ``start`` begins and
    the row after ``end`` lies; at most ``history_rows`` rows a panel and task are kept for it.
    The wide rows are then read only between the least and the greatest of these times, a range
    that reaches a Parquet scan, and only from each panel's own beginning on.
    """
    ts = F.col(spec.ts)

    def at(time) -> Column:  # by its text, so no time zone comes in
        return F.lit(str(time)).cast(df.schema[spec.ts].dataType)

    start, end = at(start), at(end)
    times = df.select(*spec.keys, spec.ts)
    newest = Window.partitionBy(*spec.keys).orderBy(ts.desc())
    before = (
        times.filter(ts < start)
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= history_rows(settings))
        .groupBy(*spec.keys)
        .agg(F.min(ts).alias("_from"))
    )
    after = times.filter(ts > end).groupBy(*spec.keys).agg(F.min(ts).alias("_to"))
    bounds = checkpointed(before.join(after, list(spec.keys), "full"))
    low, high, panels = bounds.agg(F.min("_from"), F.max("_to"), F.count(F.lit(1))).first()
    near = df.filter((ts >= (at(low) if low else start)) & (ts <= (at(high) if high else end)))
    rows = attach(near, bounds, list(spec.keys), panels).filter(
        (ts >= F.coalesce("_from", start)) & (ts <= F.coalesce("_to", end))
    )
    made = build_features(rows.drop("_from", "_to"), spec, settings, keep=keep, **how)
    return made.filter(ts.between(start, end))


def build_features_online_compat(
    df: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    keep: Sequence[str] = (),
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """What the 168-row serving buffer yields: rows from the 168th of a panel on."""
    layout = panel_layout(df, spec, settings, max_rows, rows_per_chunk)
    w = WindowColumns(layout.window)
    cols = feature_columns(spec, w, settings, convention="online_compat")
    shown = [col.alias(name) for name, col in cols.items()]
    placed = w.onto(layout.df).withColumn("_pos", layout.position())
    warm = layout.core(placed).filter(F.col("_pos") >= settings.history_rows - 1)
    return warm.select(*spec.keys, spec.ts, *keep, *shown)
