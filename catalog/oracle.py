"""The same queries in SQL for DuckDB, over the same tables."""

from __future__ import annotations

ZONES = ("af", "ao", "nf", "no", "rf", "ro")
OTHERS = ZONES[1:]
HOURLY = ("click", "error", "purchase", "signup", "view")
LAGS = (*range(1, 25), 48, 168)
PI2 = "(2.0::DOUBLE * pi())"


def r(expr: str) -> str:
    """Six decimals, and no negative zero."""
    return f"(CASE WHEN round({expr}, 6) = 0 THEN 0.0::DOUBLE ELSE round({expr}, 6) END)"


def cols(pairs: dict[str, str]) -> str:
    return ", ".join(f'{expr} AS "{name}"' for name, expr in pairs.items())


def rounded(names) -> str:
    return cols({n: r(f'"{n}"') for n in names})


_SPARSE = (
    "SELECT date_trunc('day', l_shipdate)::TIMESTAMP AS ts, "
    + ", ".join(
        f"sum(CASE WHEN l_returnflag || l_linestatus = '{z.upper()}' THEN l_quantity END) AS \"{z}\""
        for z in ZONES
    )
    + " FROM lineitem GROUP BY 1"
)
DENSE = (
    f"sparse AS ({_SPARSE}), "
    "cal AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM sparse), "
    "dense AS (SELECT 'all' AS panel_id, cal.ts::TIMESTAMP AS ts, "
    "row_number() OVER (ORDER BY cal.ts) - 1 AS sequence_id, "
    + ", ".join(f'coalesce(sparse."{z}", 0.0) AS "{z}"' for z in ZONES)
    + " FROM cal LEFT JOIN sparse ON cal.ts = sparse.ts)"
)
DENSE_SUPPLIER = (
    "sparse AS ("
    + _SPARSE.replace("SELECT ", "SELECT l_suppkey::VARCHAR AS panel_id, ", 1).replace(
        "GROUP BY 1", "GROUP BY 1, 2"
    )
    + "), bounds AS (SELECT min(ts) AS a, max(ts) AS b FROM sparse), "
    "days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::TIMESTAMP AS ts FROM bounds), "
    "ids AS (SELECT DISTINCT panel_id FROM sparse), "
    "dense AS (SELECT ids.panel_id, days.ts, "
    + ", ".join(f'coalesce(sparse."{z}", 0.0) AS "{z}"' for z in ZONES)
    + " FROM ids CROSS JOIN days LEFT JOIN sparse "
    "ON sparse.panel_id = ids.panel_id AND sparse.ts = days.ts)"
)
_Z = ", ".join(f'"{z}"' for z in ZONES)
HOUR_PANEL = (
    "hours AS (SELECT 'all' AS panel_id, date_trunc('hour', ts)::TIMESTAMP AS ts, "
    + ", ".join(f"sum(CASE WHEN event_type = '{z}' THEN value END) AS \"{z}\"" for z in HOURLY)
    + " FROM events GROUP BY 2)"
)
SERIES = (
    "series AS (SELECT l_suppkey AS panel_id, date_trunc('day', l_shipdate)::TIMESTAMP AS ts, "
    "sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)"
)
DIRTY = (
    DENSE
    + ", numbered AS (SELECT *, date_diff('day', TIMESTAMP '1970-01-01', ts) AS d FROM dense), "
    "faulty AS (SELECT panel_id, ts, d, af, CASE WHEN d % 41 = 3 THEN NULL ELSE ao END AS ao, "
    'CASE WHEN d % 53 = 7 THEN -1.0 - nf ELSE nf END AS nf, "no", rf, '
    "CASE WHEN d % 211 = 11 THEN ro * 100 + 10000 ELSE ro END AS ro "
    "FROM numbered WHERE d % 97 <> 5), "
    "raw AS (SELECT panel_id, (d * 10)::BIGINT AS ingest_seq, ts, "
    + _Z
    + " FROM faulty UNION ALL SELECT panel_id, (d * 10 + 1)::BIGINT, ts, "
    "CASE WHEN d % 58 = 1 THEN NULL ELSE af + 1 END, "
    + ", ".join(f'"{z}" + 1' for z in OTHERS)
    + " FROM faulty WHERE d % 29 = 1)"
)
_COMPLETE = " AND ".join(f'"{z}" IS NOT NULL' for z in ZONES)
CLEAN = (
    DIRTY
    + ", kept AS (SELECT * FROM raw QUALIFY row_number() OVER "
    "(PARTITION BY panel_id, ts ORDER BY ingest_seq DESC) = 1), "
    "cleaned AS (SELECT panel_id, ts, "
    + ", ".join(f'CASE WHEN "{z}" < 0 THEN 0.0 ELSE "{z}" END AS "{z}"' for z in ZONES)
    + f" FROM kept WHERE {_COMPLETE})"
)

# Feature expressions over a window named w


def lag_cols(name: str, ks) -> dict[str, str]:
    return {f"{name}_lag_{k}": f'lag("{name}", {k}) OVER w' for k in ks}


def frame(n: int, part: str = "PARTITION BY panel_id") -> str:
    return f"({part} ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def trailing_cols(name: str, n: int, stats, rows: int | None = None) -> dict[str, str]:
    rows = rows or n
    made = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    return {
        f"{name}_roll_{s}_{n}h": f'CASE WHEN count("{name}") OVER {frame(rows)} = {rows} '
        f'THEN {made[s]}("{name}") OVER {frame(rows)} END'
        for s in stats
    }


def ratio(num: str, den: str, policy: str, fallback: str) -> str:
    if policy == "fallback":
        zero = f"WHEN {den} = 0 AND {num} IS NOT NULL THEN {fallback}"
    elif policy == "ieee":
        zero = (
            f"WHEN {den} = 0 AND {num} > 0 THEN 'inf'::DOUBLE "
            f"WHEN {den} = 0 AND {num} < 0 THEN '-inf'::DOUBLE"
        )
    else:
        zero = ""
    return f"CASE WHEN {den} <> 0 THEN {num} / {den} {zero} END"


def ratio_cols(policy: str) -> dict[str, str]:
    total = "(" + " + ".join(f'"{z}"' for z in ZONES) + ")"
    return {
        "af_ratio_24h": ratio("af", "(lag(af, 24) OVER w)", policy, "1.0"),
        "af_to_ao_ratio": ratio("af", "ao", policy, "1.0"),
        "af_to_total_ratio": ratio("af", total, policy, "0.0"),
    }


def diff_cols(name: str) -> dict[str, str]:
    return {f"{name}_diff_{k}h": f"{name} - lag({name}, {k}) OVER w" for k in (1, 24)}


def cal_numbers() -> dict[str, str]:
    return {
        "hour_of_day": "hour(ts)::DOUBLE",
        "day_of_week": "(isodow(ts) - 1)::DOUBLE",
        "month": "month(ts)::DOUBLE",
        "day_of_year": "dayofyear(ts)::DOUBLE",
        "is_weekend": "(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END)::DOUBLE",
    }


def cal_circles() -> dict[str, str]:
    out = {}
    for name, value, period in (
        ("hour", "hour(ts)", 24),
        ("dow", "(isodow(ts) - 1)", 7),
        ("month", "month(ts)", 12),
    ):
        for fn in ("sin", "cos"):
            out[f"{name}_{fn}"] = f"{fn}({PI2} * {value} / {period}.0)"
    return out


def features(policy: str, compat: bool = False) -> dict[str, str]:
    shift = 1 if compat else 0
    out: dict[str, str] = {}
    for z, ks in [("af", LAGS)] + [(z, (1, 24)) for z in OTHERS]:
        for k in ks:
            out[f"{z}_lag_{k}"] = f'lag("{z}", {k - shift}) OVER w'
    for n in (24, 48, 168):
        out |= trailing_cols("af", n, ("mean", "std"), min(n, 167) if compat else n)
    out |= trailing_cols("af", 24, ("min", "max"))
    for z in OTHERS:
        out |= trailing_cols(z, 24, ("mean",))
    out |= cal_numbers() | cal_circles()
    out |= diff_cols("af")
    out |= ratio_cols(policy)
    return out


def feature_cte(policy: str, dense: str = DENSE) -> str:
    made = features(policy)
    known = " AND ".join(f'"{n}" IS NOT NULL' for n in made)
    return (
        f"{dense}, every AS (SELECT panel_id, ts, af, {cols(made)}, lead(af, 1) OVER w AS target "
        "FROM dense WINDOW w AS (PARTITION BY panel_id ORDER BY ts)), "
        f"feats AS (SELECT * FROM every WHERE {known} AND target IS NOT NULL)"
    )


def feature_query(policy: str, dense: str = DENSE) -> str:
    names = [*features(policy), "target"]
    return f"WITH {feature_cte(policy, dense)} SELECT panel_id, ts, {rounded(names)} FROM feats"


def on_series(made: dict[str, str]) -> str:
    return (
        f"WITH {SERIES}, made AS (SELECT panel_id, ts, v, {cols(made)} FROM series "
        "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
        f"SELECT panel_id, ts, {rounded(['v', *made])} FROM made"
    )


def on_panel(made: dict[str, str]) -> str:
    return (
        f"WITH {DENSE}, made AS (SELECT panel_id, ts, {cols(made)} FROM dense "
        "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
        f"SELECT panel_id, ts, {rounded(made)} FROM made"
    )


# Prices, noise, results


def price(load: str) -> str:
    return f"(15.0::DOUBLE + 0.005::DOUBLE * {load} + 0.000002::DOUBLE * ({load} * {load}))"


def noise(key: str) -> str:
    digest = f"md5('42:' || ({key})::VARCHAR)"
    h1 = f"('0x' || substr({digest}, 1, 8))::UBIGINT::DOUBLE"
    h2 = f"('0x' || substr({digest}, 9, 8))::UBIGINT::DOUBLE"
    u1 = f"(({h1} + 1.0::DOUBLE) / 4294967297.0::DOUBLE)"
    u2 = f"({h2} / 4294967296.0::DOUBLE)"
    return f"(sqrt(-2.0::DOUBLE * ln({u1})) * cos({PI2} * {u2}) * 2.0::DOUBLE)"


RESULTS = (
    DENSE
    + ", paired AS (SELECT *, lag(af, 1) OVER (ORDER BY ts) AS p FROM dense), "
    "results AS (SELECT panel_id, ts, sequence_id, p AS load_forecast_mw, "
    f"{price('p')} AS price_forecast_usd_mwh, af AS load_actual_mw, "
    f"{price('af')} + {noise('sequence_id')} AS price_actual_usd_mwh, "
    "(100000 + (sequence_id * 7919) % 50000)::BIGINT AS latency_ns "
    "FROM paired WHERE p IS NOT NULL)"
)
RESULT_DOUBLES = (
    "load_forecast_mw",
    "price_forecast_usd_mwh",
    "load_actual_mw",
    "price_actual_usd_mwh",
)
ERRORS = (
    "errors AS (SELECT *, load_forecast_mw - load_actual_mw AS load_error_mw, "
    "price_forecast_usd_mwh - price_actual_usd_mwh AS price_error_usd_mwh, "
    "latency_ns / 1e6::DOUBLE AS inference_latency_ms FROM results)"
)


def mae(a: str, p: str) -> str:
    return f"coalesce(avg(abs({a} - {p})), 0.0)"


def rmse(a: str, p: str) -> str:
    return f"coalesce(sqrt(avg(({a} - {p}) * ({a} - {p}))), 0.0)"


def mape(a: str, p: str) -> str:
    both = f"{a} IS NOT NULL AND {p} IS NOT NULL"
    return (
        f"CASE WHEN count(*) FILTER (WHERE {both}) = 0 THEN 0.0 "
        f"WHEN count(*) FILTER (WHERE {both} AND {a} <> 0) = 0 THEN 'inf'::DOUBLE "
        f"ELSE 100.0 * avg(CASE WHEN {a} <> 0 THEN abs(({a} - {p}) / {a}) END) END"
    )


def n_both(a: str, p: str) -> str:
    return f"count(*) FILTER (WHERE {a} IS NOT NULL AND {p} IS NOT NULL)"


def error_cols(a: str, p: str, prefix: str = "") -> dict[str, str]:
    return {
        f"{prefix}mae": r(mae(a, p)),
        f"{prefix}rmse": r(rmse(a, p)),
        f"{prefix}mape": r(mape(a, p)),
    }


def error_table(source: str, keys: str, a: str, p: str) -> str:
    return (
        f"SELECT {keys}, {cols(error_cols(a, p))}, {n_both(a, p)} AS n_samples "
        f"FROM {source} GROUP BY {keys}"
    )


def windowed_metrics(frame_sql: str) -> str:
    out = {}
    for prefix, a, p in (
        ("load_", "load_actual_mw", "load_forecast_mw"),
        ("price_", "price_actual_usd_mwh", "price_forecast_usd_mwh"),
    ):
        out[f"{prefix}mae"] = f"avg(abs({a} - {p})) OVER {frame_sql}"
        out[f"{prefix}rmse"] = f"sqrt(avg(({a} - {p}) * ({a} - {p})) OVER {frame_sql})"
        out[f"{prefix}mape"] = (
            f"CASE WHEN sum(CASE WHEN {a} <> 0 THEN 1 ELSE 0 END) OVER {frame_sql} = 0 "
            "THEN 'inf'::DOUBLE ELSE 100.0 * avg(CASE WHEN "
            f"{a} <> 0 THEN abs(({a} - {p}) / {a}) END) OVER {frame_sql} END"
        )
    return cols(out)


METRIC_NAMES = ("load_mae", "load_rmse", "load_mape", "price_mae", "price_rmse", "price_mape")
SNAPSHOTS = (
    f"{RESULTS}, running AS (SELECT *, row_number() OVER (ORDER BY sequence_id) AS k, "
    + windowed_metrics("(ORDER BY sequence_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    + " FROM results), shots AS (SELECT panel_id, (k // 24)::BIGINT AS snapshot, "
    f"k::BIGINT AS events_processed, {rounded(METRIC_NAMES)} FROM running WHERE k % 24 = 0)"
)


def folds(source: str, pos: str, n: str, keep: str, embargo: int = 0) -> str:
    end = f"CASE WHEN f.fold = 4 THEN {n} ELSE ({n} // 5) * (f.fold + 1) END"
    start = f"({n} // 5) * f.fold"
    role = (
        f"CASE WHEN {pos} < {start} - {embargo} THEN 'train' "
        f"WHEN {pos} >= {start} AND {pos} < {end} THEN 'validate' END"
    )
    return (
        f"SELECT * FROM (SELECT {keep}, {pos} AS row_index, f.fold, {role} AS role FROM {source}, "
        "(VALUES (1), (2), (3), (4)) f(fold)) WHERE role IS NOT NULL"
    )


EVENT_POS = (
    "placed AS (SELECT 'all' AS panel_id, ts, event_id, "
    "row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n FROM events)"
)
PERSISTENCE_FOLDS = (
    f"{RESULTS}, placed AS (SELECT *, row_number() OVER (ORDER BY sequence_id) - 1 AS pos, "
    "count(*) OVER () AS n FROM results), members AS ("
    + folds("placed", "pos", "n", "load_actual_mw, load_forecast_mw")
    + "), scored AS (SELECT fold, "
    + n_both("load_actual_mw", "load_forecast_mw")
    + " AS val_rows, "
    + mae("load_actual_mw", "load_forecast_mw")
    + " AS val_mae, "
    + rmse("load_actual_mw", "load_forecast_mw")
    + " AS val_rmse, "
    + mape("load_actual_mw", "load_forecast_mw")
    + " AS val_mape FROM members WHERE role = 'validate' GROUP BY fold)"
)


def baseline_cols(series: str, convention: str) -> dict[str, str]:
    near = f"lag({series}, 1) OVER w" if convention == "shifted" else series
    recent = "(PARTITION BY panel_id ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
    return {
        "naive_persistence": near,
        "seasonal_naive": f"lag({series}, 168) OVER w",
        "moving_average_24h": f"CASE WHEN count({series}) OVER {recent} = 24 "
        f"THEN avg({series}) OVER {recent} END",
    }


def baseline_eval(series: str, convention: str, dense: str = DENSE, each: str = "panel_id") -> str:
    """Scores of the baselines, of each panel or (``each`` empty) of all together."""
    made = baseline_cols(series, convention)
    key, group = (f"{each}, ", f"GROUP BY {each}") if each else ("", "")
    parts = []
    for name in made:
        a = f"(CASE WHEN {name} IS NOT NULL THEN target END)"
        parts.append(
            f"SELECT {key}'{name}' AS baseline, {cols(error_cols(a, name))}, "
            f"{n_both('target', name)} AS n_samples FROM base {group}"
        )
    return (
        f"WITH {feature_cte('fallback', dense)}, base AS (SELECT panel_id, target, {cols(made)} FROM feats "
        "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) " + " UNION ALL ".join(parts)
    )


# Requests


REQUESTS = (
    DENSE
    + ", windows AS (SELECT sequence_id, ts, "
    + ", ".join(
        f'list("{z}") OVER (ORDER BY ts ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS "{z}"'
        for z in ZONES
    )
    + " FROM dense), taken AS (SELECT sequence_id - 167 AS request_id, * FROM windows "
    "WHERE sequence_id >= 167), "
    "requests AS (SELECT request_id::BIGINT AS request_id, ts, af, ao, "
    'CASE WHEN request_id % 7 = 3 THEN nf[1:167] ELSE nf END AS nf, "no", rf, ro FROM taken), '
    "checked AS (SELECT *, least("
    + ", ".join(f'len("{z}")' for z in ZONES)
    + ")::BIGINT AS n_values FROM requests)"
)


def request_features() -> str:
    made: dict[str, str] = {}
    for z, ks in [("af", LAGS)] + [(z, (1, 24)) for z in OTHERS]:
        for k in ks:
            made[f"{z}_lag_{k}"] = f'"{z}"[169 - {k}]'

    def before(z: str, n: int) -> str:
        return f'"{z}"[{168 - min(n, 167)}:167]'

    for n in (24, 48, 168):
        made[f"af_roll_mean_{n}h"] = f"list_avg({before('af', n)})"
        made[f"af_roll_std_{n}h"] = f"list_stddev_samp({before('af', n)})"
    made["af_roll_min_24h"] = f"list_min({before('af', 24)})"
    made["af_roll_max_24h"] = f"list_max({before('af', 24)})"
    for z in OTHERS:
        made[f"{z}_roll_mean_24h"] = f"list_avg({before(z, 24)})"
    made |= cal_numbers() | cal_circles()
    now = "af[168]"
    total = "(" + " + ".join(f'"{z}"[168]' for z in ZONES) + ")"
    made["af_diff_1h"] = f"{now} - af[167]"
    made["af_diff_24h"] = f"{now} - af[144]"
    made["af_ratio_24h"] = ratio(now, "af[144]", "fallback", "1.0")
    made["af_to_ao_ratio"] = ratio(now, "ao[168]", "fallback", "1.0")
    made["af_to_total_ratio"] = ratio(now, total, "fallback", "0.0")
    return (
        f"WITH {REQUESTS}, made AS (SELECT request_id, ts, {cols(made)} FROM checked "
        f"WHERE n_values >= 168) SELECT request_id, ts, {rounded(made)} FROM made"
    )


def release(cost: str, capacity: float, rate: float, keep: str) -> str:
    w = "(PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"
    pace = f"(1e6::DOUBLE / {rate})" if isinstance(rate, str) else repr(1e6 / rate)
    return (
        "WITH timed AS (SELECT *, epoch_us(ts)::DOUBLE AS t, "
        f"sum({cost}) OVER {w} AS through FROM (SELECT *, (event_id % 3 + 1)::DOUBLE AS cost FROM events)), "
        f"slack AS (SELECT *, max(t - (through - {cost}) * {pace}::DOUBLE) OVER {w} AS top FROM timed), "
        f"gone AS (SELECT *, greatest(t, top + (through - {capacity}) * {pace}::DOUBLE) AS leave FROM slack) "
        f"SELECT event_id, user_id, ts, {keep} {r('(leave - t) / 1e6::DOUBLE')} AS wait_s, "
        "make_timestamp(round(leave)::BIGINT) AS release_ts FROM gone"
    )


ORACLE: dict[str, str] = {}


def _dense_query(select: str, tail: str = "") -> str:
    return f"WITH {DENSE} SELECT {select} FROM dense {tail}"


ORACLE["csv_roundtrip"] = _dense_query(f"panel_id, ts, {rounded(ZONES)}")
ORACLE["select_required"] = f"SELECT 'all' AS panel_id, ts, {_Z} FROM ({_SPARSE})"
ORACLE["panel_daily"] = ORACLE["csv_roundtrip"]
ORACLE["panel_hourly"] = f"WITH {HOUR_PANEL} SELECT panel_id, ts, {rounded(HOURLY)} FROM hours"
ORACLE["regularized_hourly"] = (
    f"WITH {HOUR_PANEL}, cal AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) "
    f"AS ts FROM hours) SELECT 'all' AS panel_id, cal.ts::TIMESTAMP AS ts, {rounded(HOURLY)} "
    "FROM cal LEFT JOIN hours ON cal.ts = hours.ts"
)
_SHOWN = (
    f"WITH {RESULTS}, shown AS (SELECT panel_id, ts, sequence_id, latency_ns, "
    f"{rounded(RESULT_DOUBLES)} FROM results)"
)
ORACLE["forecast_messages"] = (
    f"{_SHOWN} SELECT panel_id, 'forecast' AS type, sequence_id, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S') AS logical_timestamp, load_actual_mw, load_forecast_mw, "
    f"{r('load_forecast_mw - load_actual_mw')} AS load_error_mw, price_actual_usd_mwh, "
    f"price_forecast_usd_mwh, {r('price_forecast_usd_mwh - price_actual_usd_mwh')} AS "
    f"price_error_usd_mwh, {r('latency_ns / 1e6::DOUBLE')} AS inference_latency_ms FROM shown"
)
ORACLE["metrics_messages"] = (
    f"WITH {SNAPSHOTS} SELECT panel_id, 'metrics_update' AS type, 'cumulative' AS \"window\", "
    f"{', '.join(METRIC_NAMES)}, events_processed FROM shots"
)
ORACLE["drop_incomplete"] = (
    f"SELECT 'all' AS panel_id, ts, {_Z} FROM ({_SPARSE}) WHERE {_COMPLETE}"
)
ORACLE["clip_negative"] = (
    f"WITH {DIRTY} SELECT panel_id, ingest_seq, ts, "
    + ", ".join(f'CASE WHEN "{z}" < 0 THEN 0.0 ELSE "{z}" END AS "{z}"' for z in ZONES)
    + f" FROM raw WHERE {_COMPLETE}"
)
ORACLE["price_curve"] = (
    f"WITH {SERIES} SELECT panel_id, ts, {r('v')} AS v, {r(price('v'))} AS price FROM series"
)
_KEY = "(l_orderkey * 10 + l_linenumber)"
ORACLE["price_actual"] = (
    f"SELECT {_KEY}::BIGINT AS sequence_id, {r('l_quantity')} AS l_quantity, "
    f"{r(price('l_quantity') + ' + ' + noise(_KEY))} AS price_actual FROM lineitem"
)
ORACLE["calendar_features"] = f"SELECT event_id, {cols(cal_numbers())} FROM events"
ORACLE["cyclic_features"] = (
    f"SELECT event_id, {rounded(cal_circles())} FROM "
    f"(SELECT event_id, {cols(cal_circles())} FROM events)"
)
ORACLE["diff_features"] = on_series(diff_cols("v"))
ORACLE["ratio_features"] = on_panel(ratio_cols("ieee"))
ORACLE["ratio_fallback"] = on_panel(ratio_cols("fallback"))
ORACLE["ratio_null"] = on_panel(ratio_cols("null"))
ORACLE["two_stage"] = (
    f"WITH {RESULTS} SELECT panel_id, ts, sequence_id, {rounded(RESULT_DOUBLES)}, latency_ns "
    "FROM results"
)
ORACLE["forecast_errors"] = (
    f"WITH {RESULTS}, {ERRORS} SELECT sequence_id, "
    f"{rounded(('load_error_mw', 'price_error_usd_mwh', 'inference_latency_ms'))} FROM errors"
)
ORACLE["present_forecast"] = (
    "SELECT event_id, round_even(value, 1) AS load_forecast_mw, "
    f"round_even({price('value')}, 2) AS price_forecast_usd_mwh, "
    "round_even(event_id * 7919 / 1e6::DOUBLE, 2) AS inference_latency_ms FROM events"
)
ORACLE["dedup_last"] = (
    f"SELECT l_suppkey, l_shipdate, {_KEY}::BIGINT AS ingest_seq, l_quantity, "
    "CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS l_extendedprice FROM lineitem "
    f"QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY {_KEY} DESC) = 1"
)
ORACLE["row_index"] = f"WITH {EVENT_POS} SELECT panel_id, ts, event_id, pos AS row_index FROM placed"
_CUT = "floor(n * 0.8::DOUBLE)::BIGINT"
ORACLE["chrono_split"] = (
    f"WITH {EVENT_POS} SELECT panel_id, ts, event_id, "
    f"CASE WHEN pos < {_CUT} THEN 'train' ELSE 'stream' END AS split, "
    f"CASE WHEN pos < {_CUT} THEN pos ELSE pos - {_CUT} END AS split_index FROM placed"
)
ORACLE["walk_forward_folds"] = f"WITH {EVENT_POS} " + folds(
    "placed", "pos", "n", "panel_id, ts, event_id"
)
ORACLE["folds_embargo"] = f"WITH {EVENT_POS} " + folds(
    "placed", "pos", "n", "panel_id, ts, event_id", 168
)
ORACLE["latest_points"] = (
    "SELECT event_type, ts, event_id, value FROM events QUALIFY row_number() OVER "
    "(PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 200"
)
ORACLE["first_points"] = "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 120"
_LIMITS = "limits AS (SELECT panel_id, " + ", ".join(
    f'avg("{z}") + 5.0::DOUBLE * stddev_samp("{z}") AS "{z}_limit"' for z in ZONES
) + " FROM cleaned GROUP BY panel_id)"
ORACLE["outlier_flags"] = (
    f"WITH {CLEAN}, {_LIMITS} SELECT panel_id, ts, {rounded(ZONES)}, "
    + ", ".join(f'coalesce("{z}" > "{z}_limit", false) AS "{z}_outlier"' for z in ZONES)
    + " FROM cleaned JOIN limits USING (panel_id)"
)
ORACLE["outlier_report"] = f"WITH {CLEAN}, {_LIMITS} " + " UNION ALL ".join(
    f"SELECT panel_id, '{z}' AS zone, {r(f'any_value({z}_limit)')} AS threshold, "
    f'count(*) FILTER (WHERE "{z}" > "{z}_limit") AS n_outliers '
    "FROM cleaned JOIN limits USING (panel_id) GROUP BY panel_id"
    for z in ZONES
)
ORACLE["clean_panel"] = f"WITH {CLEAN} SELECT panel_id, ts, {rounded(ZONES)} FROM cleaned"
ORACLE["csv_dirty"] = ORACLE["clean_panel"]


def _gaps(cte: str, source: str, step: float) -> str:
    return (
        f"WITH {cte}, gaps AS (SELECT panel_id, date_diff('microsecond', lag(ts) OVER "
        f"(PARTITION BY panel_id ORDER BY ts), ts) / 3.6e9::DOUBLE AS g FROM {source}) "
        f"SELECT panel_id, count(*) FILTER (WHERE g > {step}) AS gaps, "
        f"count(*) FILTER (WHERE g > {3 * step}) AS large_gaps, max(g) AS longest_gap_hours "
        "FROM gaps GROUP BY panel_id"
    )


ORACLE["gap_report"] = _gaps(CLEAN, "cleaned", 24.0)
ORACLE["gap_report_hourly"] = _gaps(HOUR_PANEL, "hours", 1.0)
ORACLE["panel_summary"] = (
    f"WITH {SERIES} SELECT panel_id, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts "
    "FROM series GROUP BY panel_id"
)
ORACLE["quality_counts"] = (
    f"WITH {CLEAN} SELECT 'all' AS panel_id, 'duplicate_ts' AS \"check\", '*' AS zone, "
    "(SELECT count(*) FROM raw) - (SELECT count(*) FROM kept) AS n "
    "UNION ALL SELECT 'all', 'incomplete', '*', "
    f"(SELECT count(*) FROM kept WHERE NOT ({_COMPLETE})) "
    + "".join(
        f"UNION ALL SELECT 'all', 'negative', '{z}', "
        f'(SELECT count(*) FROM kept WHERE {_COMPLETE} AND "{z}" < 0) '
        for z in ZONES
    )
)
ORACLE["target_lags"] = on_series(lag_cols("v", LAGS))
_cross: dict[str, str] = {}
_cross_roll: dict[str, str] = {}
for _z in OTHERS:
    _cross |= lag_cols(_z, (1, 24))
    _cross_roll |= trailing_cols(_z, 24, ("mean",))
ORACLE["cross_lags"] = on_panel(_cross)
ORACLE["cross_rolling"] = on_panel(_cross_roll)


def _rolling(stats, windows) -> str:
    made: dict[str, str] = {}
    for n in windows:
        made |= trailing_cols("v", n, stats)
    return on_series(made)


ORACLE["rolling_mean"] = _rolling(("mean",), (24, 48, 168))
ORACLE["rolling_std"] = _rolling(("std",), (24, 48, 168))
ORACLE["rolling_minmax"] = _rolling(("min", "max"), (24,))
ORACLE["feature_matrix"] = feature_query("fallback")
ORACLE["feature_matrix_ieee"] = feature_query("ieee")
ORACLE["feature_interval"] = (
    feature_query("fallback", DENSE_SUPPLIER)
    + " WHERE ts BETWEEN TIMESTAMP '1997-04-01 00:00:00' AND TIMESTAMP '1997-06-30 00:00:00'"
)
ORACLE["feature_matrix_suppliers"] = feature_query("fallback", DENSE_SUPPLIER)
_compat = features("fallback", compat=True)
ORACLE["features_online_compat"] = (
    f"WITH {DENSE}, made AS (SELECT panel_id, ts, sequence_id, {cols(_compat)} FROM dense "
    "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
    f"SELECT panel_id, ts, {rounded(_compat)} FROM made WHERE sequence_id >= 167"
)
for _key, _name in (
    ("baseline_naive", "naive_persistence"),
    ("baseline_seasonal", "seasonal_naive"),
    ("baseline_ma24", "moving_average_24h"),
):
    ORACLE[_key] = on_series({_name: baseline_cols("v", "shifted")[_name]})
ORACLE["metrics_by_panel"] = (
    f"WITH {SERIES}, pairs AS (SELECT *, lag(v, 1) OVER (PARTITION BY panel_id ORDER BY ts) AS p "
    "FROM series) " + error_table("pairs", "panel_id", "v", "p")
)
ORACLE["mape_edges"] = (
    "WITH pairs AS (SELECT edge, event_type, value + 1 AS p, CASE edge "
    "WHEN 'mixed' THEN CASE WHEN event_id % 2 = 0 THEN value ELSE 0.0 END "
    "WHEN 'zeros' THEN 0.0 WHEN 'negative' THEN -value END AS a FROM events, "
    "(VALUES ('mixed'), ('zeros'), ('empty'), ('negative')) e(edge)) "
    + error_table("pairs", "edge, event_type", "a", "p")
)
ORACLE["latency_percentiles"] = (
    "WITH timed AS (SELECT event_type, round(value * 10000)::BIGINT AS ns FROM events) "
    "SELECT event_type, "
    + ", ".join(
        f"{r(f'quantile_cont(ns::DOUBLE, {q}) / 1e6::DOUBLE')} AS {n}"
        for q, n in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"))
    )
    + " FROM timed GROUP BY event_type"
)
ORACLE["persistence_folds"] = (
    f"WITH {PERSISTENCE_FOLDS} SELECT fold, val_rows, val_rows % 37 + fold AS best_iteration, "
    f"{rounded(('val_mae', 'val_rmse', 'val_mape'))} FROM scored"
)
ORACLE["fold_averages"] = (
    f"WITH {PERSISTENCE_FOLDS} SELECT {r('avg(val_mae)')} AS mae, {r('avg(val_rmse)')} AS rmse, "
    f"{r('avg(val_mape)')} AS mape, "
    "floor(avg(val_rows % 37 + fold))::BIGINT AS average_best_iteration FROM scored"
)
ORACLE["baseline_eval"] = baseline_eval("af_lag_1", "shifted")
ORACLE["baseline_eval_current"] = baseline_eval("af", "current")
ORACLE["baseline_eval_suppliers"] = baseline_eval("af_lag_1", "shifted", DENSE_SUPPLIER)
ORACLE["metric_snapshots"] = f"WITH {SNAPSHOTS} SELECT * FROM shots"
ORACLE["rolling_metrics"] = (
    f"WITH {RESULTS}, rolled AS (SELECT panel_id, sequence_id, "
    "row_number() OVER (ORDER BY sequence_id) AS k, "
    + windowed_metrics("(ORDER BY sequence_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)")
    + f" FROM results) SELECT panel_id, sequence_id, {rounded(METRIC_NAMES)} FROM rolled WHERE k >= 24"
)
ORACLE["final_metrics"] = (
    f"WITH {RESULTS} SELECT panel_id, "
    + cols(
        error_cols("load_actual_mw", "load_forecast_mw", "load_")
        | error_cols("price_actual_usd_mwh", "price_forecast_usd_mwh", "price_")
    )
    + ", count(*) AS events_processed, "
    + ", ".join(
        f"{r(f'quantile_cont(latency_ns::DOUBLE, {q}) / 1e6::DOUBLE')} AS {n}"
        for q, n in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"))
    )
    + " FROM results GROUP BY panel_id"
)
ORACLE["error_histogram"] = (
    f"WITH {RESULTS}, {ERRORS}, recent AS (SELECT panel_id, load_error_mw AS e FROM errors "
    "ORDER BY sequence_id DESC LIMIT 200), ranged AS (SELECT *, min(e) OVER () AS lo, "
    "(max(e) OVER () - min(e) OVER ()) / 30.0::DOUBLE AS wd FROM recent), "
    "binned AS (SELECT *, CASE WHEN wd = 0 THEN 0 ELSE least(floor((e - lo) / wd), 29) END::INTEGER "
    "AS bin FROM ranged) "
    f"SELECT panel_id, bin, {r('any_value(lo + bin * wd)')} AS bin_start, "
    f"{r('any_value(lo + (bin + 1) * wd)')} AS bin_end, count(*) AS n "
    "FROM binned GROUP BY panel_id, bin"
)
_AS_OF = "ts <= TIMESTAMP '2024-01-12 12:00:00'"
ORACLE["replay_status"] = (
    f"SELECT user_id, max(CASE WHEN {_AS_OF} THEN ts END) AS logical_time, "
    f"count(*) FILTER (WHERE {_AS_OF}) AS events_emitted, "
    f"count(*) - count(*) FILTER (WHERE {_AS_OF}) AS events_remaining, "
    f"round_even(100.0::DOUBLE * count(*) FILTER (WHERE {_AS_OF}) / count(*), 1) AS progress_pct, "
    f"count(*) FILTER (WHERE {_AS_OF}) >= 168 AS buffer_warm FROM events GROUP BY user_id"
)
ORACLE["release_schedule"] = release("1.0::DOUBLE", 3.0, 1.0 / 21600.0, "")
ORACLE["release_schedule_cost"] = release("cost", 4.0, 1.0 / 7200.0, "cost,")
ORACLE["request_validation"] = (
    f"WITH {REQUESTS} SELECT request_id, ts, n_values, "
    "CASE WHEN n_values < 168 THEN 'rejected' ELSE 'accepted' END AS status, "
    "CASE WHEN n_values < 168 THEN 'shortest array has ' || n_values || ' values, 168 needed' END "
    "AS reason FROM checked"
)
ORACLE["request_rows"] = (
    f"WITH {REQUESTS}, spread AS (SELECT request_id, ts AS t, unnest(range(168)) AS position, * "
    "EXCLUDE (request_id, ts) FROM checked WHERE n_values >= 168) "
    "SELECT request_id, position::BIGINT AS position, "
    "(t - to_hours((167 - position)::BIGINT))::TIMESTAMP AS ts, "
    + ", ".join(f'"{z}"[position + 1] AS "{z}"' for z in ZONES)
    + " FROM spread"
)
ORACLE["request_features"] = request_features()
ORACLE["stream_replay"] = _dense_query(f"panel_id, sequence_id, ts, {rounded(ZONES)}")
ORACLE["stream_features"] = ORACLE["feature_matrix"]
ORACLE["stream_features_suppliers"] = ORACLE["feature_matrix_suppliers"]
ORACLE["stream_features_compat"] = ORACLE["features_online_compat"]
_served = features("fallback")
_known = " AND ".join(f'"{n}" IS NOT NULL' for n in _served)
ORACLE["stream_features_windowed"] = (
    f"WITH {DENSE}, every AS (SELECT panel_id, ts, {cols(_served)} FROM dense "
    "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
    f"SELECT panel_id, ts, {rounded(_served)} FROM every WHERE {_known}"
)
ORACLE["stream_features_windowed_suppliers"] = (
    f"WITH {DENSE_SUPPLIER}, every AS (SELECT panel_id, ts, {cols(_served)} FROM dense "
    "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
    f"SELECT panel_id, ts, {rounded(_served)} FROM every WHERE {_known}"
)
ORACLE["stream_snapshots"] = ORACLE["metric_snapshots"]
ORACLE["stream_messages"] = ORACLE["forecast_messages"]




def arrived(dense: str) -> str:
    """Tagged arrivals (``told``) of the events in ``dense``, see the arrival fixtures."""
    return (
        dense
        + ", came AS (SELECT *, sequence_id + (sequence_id * 7919) % 6 + "
        "CASE WHEN sequence_id % 97 = 13 THEN 1000 ELSE 0 END + lag AS arrival FROM events_, "
        "(VALUES (0), (2), (200)) l(lag) WHERE lag = 0 OR (lag = 2 AND sequence_id % 50 = 7) "
        "OR (lag = 200 AND sequence_id % 100 = 3)), "
        "clocked AS (SELECT *, max(ts) OVER (PARTITION BY panel_id ORDER BY arrival, ts "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 DAY AS clock FROM came), "
        "ranked AS (SELECT *, coalesce(ts <= clock, false) AS late, row_number() OVER (PARTITION BY panel_id, "
        "ts, coalesce(ts <= clock, false) ORDER BY arrival DESC) AS nth FROM clocked), "
        "used AS (SELECT *, row_number() OVER (PARTITION BY panel_id ORDER BY ts) AS pos, "
        "count(*) OVER (PARTITION BY panel_id) AS n FROM ranked WHERE NOT late AND nth = 1), "
        "told AS (SELECT panel_id, sequence_id, CASE WHEN late THEN 'late' ELSE 'repeated' END AS kind "
        "FROM ranked WHERE late OR nth > 1 UNION ALL SELECT panel_id, sequence_id, "
        "CASE WHEN pos = n THEN 'open' WHEN pos > 168 THEN 'feature' ELSE 'warmup' END FROM used)"
    )


NUMBERED_SUPPLIER = DENSE_SUPPLIER + (
    ", events_ AS (SELECT *, date_diff('day', DATE '1970-01-01', ts::DATE) AS sequence_id FROM dense)"
)
ORACLE["stream_late"] = (
    "WITH " + arrived(DENSE + ", events_ AS (SELECT * FROM dense)")
    + f", every AS (SELECT panel_id, ts, sequence_id, {cols(_served)} FROM used "
    "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
    f"SELECT panel_id, ts, sequence_id, {rounded(_served)} FROM every WHERE {_known}"
)
ORACLE["stream_late_events"] = (
    f"WITH {arrived(NUMBERED_SUPPLIER)} SELECT panel_id, sequence_id, kind, NULL::BIGINT AS n_in, "
    "NULL::BIGINT AS n_late, NULL::BIGINT AS n_repeated, NULL::BIGINT AS n_untimed FROM told UNION ALL "
    "SELECT panel_id, NULL, 'end', count(*), count(*) FILTER (kind = 'late'), "
    "count(*) FILTER (kind = 'repeated'), 0 FROM told GROUP BY panel_id"
)
ORACLE["stream_repeated"] = (
    f"WITH {NUMBERED_SUPPLIER} SELECT panel_id, sequence_id, ts, {rounded(ZONES)} FROM events_"
)
ORACLE["stream_settled"] = (
    f"WITH {NUMBERED_SUPPLIER}, ahead AS (SELECT panel_id, sequence_id, ts, {r('af')} AS load_forecast_mw, "
    "lead(CASE WHEN sequence_id % 41 <> 3 THEN af END, 1) OVER (PARTITION BY panel_id ORDER BY ts) AS later "
    f"FROM events_) SELECT panel_id, sequence_id, ts, load_forecast_mw, {r('later')} AS load_actual_mw FROM ahead"
)
_PREFIX = "(PARTITION BY panel_id ORDER BY sequence_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
RESULTS_SUPPLIER = RESULTS.replace(DENSE, NUMBERED_SUPPLIER).replace(
    "lag(af, 1) OVER (ORDER BY ts) AS p FROM dense",
    "lag(af, 1) OVER (PARTITION BY panel_id ORDER BY ts) AS p FROM events_",
)


def _shots(results: str, more: str) -> str:
    return (
        f"WITH {results}, running AS (SELECT *, row_number() OVER (PARTITION BY panel_id ORDER BY sequence_id) AS k, "
        + windowed_metrics(_PREFIX)
        + "".join(
            f", quantile_cont(latency_ns::DOUBLE, {q}) OVER {_PREFIX} / 1e6::DOUBLE AS {n}"
            for q, n in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"))
        )
        + " FROM results) SELECT panel_id, (k // 24)::BIGINT AS snapshot, k::BIGINT AS events_processed, "
        f"{rounded(METRIC_NAMES)}, {more} FROM running WHERE k % 24 = 0"
    )


_LATENCY = ", ".join(f"round({n}, 9) AS {n}" for n in ("p50_ms", "p95_ms", "p99_ms"))
ORACLE["snapshot_latency"] = _shots(RESULTS, _LATENCY)
ORACLE["snapshot_latency_suppliers"] = _shots(RESULTS_SUPPLIER, _LATENCY)
ORACLE["stream_snapshots_suppliers"] = _shots(
    RESULTS_SUPPLIER, "true AS p50_ms_near, true AS p95_ms_near, true AS p99_ms_near"
)

# The plan for long groups gives the same rows

for _key in ("row_index", "feature_matrix", "metric_snapshots", "release_schedule"):
    ORACLE[f"{_key}_chunked"] = ORACLE[_key]


# What of the model's results does not hang on the fit


def part_of_panel(condition: str, first: str) -> str:
    """The dense panel's train or stream part, numbered from ``first``."""
    return (
        DENSE.replace("dense AS (SELECT 'all'", "panel AS (SELECT 'all'")
        + ", cut AS (SELECT floor(count(*) * 0.8::DOUBLE)::BIGINT AS k FROM panel), "
        f"dense AS (SELECT panel.* REPLACE (sequence_id - {first} AS sequence_id) FROM panel, cut "
        f"WHERE {condition})"
    )


def forecast_rows(dense: str) -> str:
    return (
        f"WITH {feature_cte('fallback', dense)} SELECT feats.panel_id, feats.ts, sequence_id, "
        f"{r('target')} AS load_actual_mw, {r(price('target') + ' + ' + noise('sequence_id'))} AS price_actual_usd_mwh, "
        "true AS price_on_curve, true AS not_negative "
        "FROM feats JOIN dense ON dense.panel_id = feats.panel_id AND dense.ts = feats.ts"
    )


ORACLE["forecast_rows"] = forecast_rows(part_of_panel("sequence_id >= k", "k"))
ORACLE["stream_forecast_rows"] = forecast_rows(DENSE)
ORACLE["fold_sizes"] = (
    f"WITH {feature_cte('fallback', part_of_panel('sequence_id < k', '0'))}, "
    "sized AS (SELECT count(*) AS n FROM feats) SELECT fold, (n // 5) * fold AS train_rows, "
    "CASE WHEN fold = 4 THEN n ELSE (n // 5) * (fold + 1) END - (n // 5) * fold AS val_rows "
    "FROM sized, (VALUES (1), (2), (3), (4)) f(fold)"
)
ORACLE["request_answers"] = (
    f"WITH {REQUESTS} SELECT request_id, (ts + INTERVAL 1 HOUR)::TIMESTAMP AS timestamp_predicted, "
    "true AS load_rounded, true AS price_rounded, 'load_model' AS model_version "
    "FROM checked WHERE n_values >= 168"
)
ORACLE["current_beats_all"] = (
    f"WITH least AS (SELECT panel_id, min(mae) AS m FROM ({ORACLE['baseline_eval']}) GROUP BY panel_id), "
    f"ours AS (WITH {feature_cte('fallback')} SELECT panel_id, {mae('target', 'af')} AS e FROM feats GROUP BY panel_id) "
    f"SELECT panel_id, {r('e')} AS model_mae, e < m AS model_beats_all_baselines FROM ours JOIN least USING (panel_id)"
)
_HELD = part_of_panel("sequence_id >= k", "k")
_TRAIN = part_of_panel("sequence_id < k", "0")
_FEATURES = [*features("fallback")]
ORACLE["evaluation_baselines"] = (
    f"SELECT (SELECT count(*) FROM (WITH {feature_cte('fallback', _HELD)} SELECT * FROM feats)) AS evaluation_set_rows, "
    f"baseline, mae, rmse, mape, n_samples FROM ({baseline_eval('af_lag_1', 'shifted', _HELD)})"
)
ORACLE["training_checks"] = (
    f"WITH {feature_cte('fallback', _TRAIN)} SELECT count(*) AS n_training_rows, {len(_FEATURES)}::BIGINT AS n_features, "
    f"'{','.join(sorted(_FEATURES))}' AS feature_names, 4::BIGINT AS n_folds, 3::BIGINT AS n_baselines, "
    f"{len(_FEATURES)}::BIGINT AS n_importances, 1.0::DOUBLE AS sum_importances FROM feats"
)
ORACLE["model_reload"] = (
    f"WITH {feature_cte('fallback', _HELD)} SELECT panel_id, ts, true AS same_score FROM feats"
)
ORACLE["clipped_forecast"] = (
    f"WITH {NUMBERED_SUPPLIER}, made AS (SELECT *, greatest(ao - 20, 0.0::DOUBLE) AS p FROM events_) "
    f"SELECT panel_id, ts, sequence_id, {r('p')} AS load_forecast_mw, {r(price('p'))} AS price_forecast_usd_mwh, "
    f"{r('af')} AS load_actual_mw, {r(price('af') + ' + ' + noise('sequence_id'))} AS price_actual_usd_mwh FROM made"
)


# The same for every supplier

SERIAL_SUPPLIER = DENSE_SUPPLIER.replace(
    "dense AS (SELECT ids.panel_id, days.ts, ",
    "dense AS (SELECT ids.panel_id, days.ts, date_diff('day', DATE '1970-01-01', days.ts::DATE) AS sequence_id, ",
)


def part_of_suppliers(condition: str, first: str) -> str:
    """Every supplier's train or stream part, numbered from ``first``."""
    return (
        DENSE_SUPPLIER.replace("dense AS (SELECT ids", "panel AS (SELECT ids")
        + ", placed AS (SELECT *, row_number() OVER (PARTITION BY panel_id ORDER BY ts) - 1 AS pos, "
        "floor(count(*) OVER (PARTITION BY panel_id) * 0.8::DOUBLE)::BIGINT AS k FROM panel), "
        f"dense AS (SELECT * EXCLUDE (pos, k), pos - {first} AS sequence_id FROM placed WHERE {condition})"
    )


_HELD_EACH = part_of_suppliers("pos >= k", "k")
_compat_known = "row_number() OVER (PARTITION BY panel_id ORDER BY ts) > 167"
ORACLE["stream_features_compat_suppliers"] = (
    f"WITH {DENSE_SUPPLIER}, made AS (SELECT panel_id, ts, {_compat_known} AS known, {cols(_compat)} FROM dense "
    "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
    f"SELECT panel_id, ts, {rounded(_compat)} FROM made WHERE known"
)
ORACLE["stream_messages_suppliers"] = ORACLE["forecast_messages"].replace(RESULTS, RESULTS_SUPPLIER)
ORACLE["stream_forecast_rows_suppliers"] = forecast_rows(SERIAL_SUPPLIER)
ORACLE["forecast_rows_suppliers"] = forecast_rows(_HELD_EACH)
ORACLE["stream_late_suppliers"] = (
    f"WITH {arrived(NUMBERED_SUPPLIER)}, every AS (SELECT panel_id, ts, sequence_id, {cols(_served)} FROM used "
    "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
    f"SELECT panel_id, ts, sequence_id, {rounded(_served)} FROM every WHERE {_known}"
)
ORACLE["fold_sizes_suppliers"] = (
    f"WITH {feature_cte('fallback', part_of_suppliers('pos < k', '0'))}, "
    "sized AS (SELECT panel_id, count(*) AS n FROM feats GROUP BY panel_id) "
    "SELECT fold, sum((n // 5) * fold)::BIGINT AS train_rows, sum(CASE WHEN fold = 4 THEN n "
    "ELSE (n // 5) * (fold + 1) END - (n // 5) * fold)::BIGINT AS val_rows "
    "FROM sized, (VALUES (1), (2), (3), (4)) f(fold) GROUP BY fold"
)
ORACLE["evaluation_baselines_suppliers"] = (
    f"SELECT (SELECT count(*) FROM (WITH {feature_cte('fallback', _HELD_EACH)} SELECT * FROM feats)) AS evaluation_set_rows, "
    f"baseline, mae, rmse, mape, n_samples FROM ({baseline_eval('af_lag_1', 'shifted', _HELD_EACH, each='')})"
)
_ASKED = "day(ts) = 1 AND pos >= 168"
_ASKING = (
    NUMBERED_SUPPLIER + ", numbered AS (SELECT *, panel_id::BIGINT * 100000 + sequence_id AS request_id, "
    "row_number() OVER (PARTITION BY panel_id ORDER BY ts) - 1 AS pos FROM events_)"
)
ORACLE["request_validation_suppliers"] = (
    f"WITH {_ASKING} SELECT request_id, ts, (CASE WHEN request_id % 7 = 3 THEN 168 ELSE 169 END)::BIGINT AS n_values, "
    "CASE WHEN request_id % 7 = 3 THEN 'rejected' ELSE 'accepted' END AS status, "
    "CASE WHEN request_id % 7 = 3 THEN 'shortest array has 168 values, 169 needed' END AS reason "
    f"FROM numbered WHERE {_ASKED}"
)
ORACLE["request_features_parity"] = (
    f"WITH {_ASKING}, every AS (SELECT panel_id, ts, request_id, pos, {cols(_served)} FROM numbered "
    "WINDOW w AS (PARTITION BY panel_id ORDER BY ts)) "
    f"SELECT request_id, ts, {rounded(_served)} FROM every WHERE {_ASKED} AND request_id % 7 <> 3"
)
ORACLE["request_answers_suppliers"] = (
    f"WITH {_ASKING} SELECT request_id, (ts + INTERVAL 1 HOUR)::TIMESTAMP AS timestamp_predicted, "
    "true AS load_rounded, true AS price_rounded, NULL::DOUBLE AS inference_latency_ms, "
    f"'load_model' AS model_version FROM numbered WHERE {_ASKED} AND request_id % 7 <> 3"
)
