import math

import pytest
from pyspark.sql import functions as F

from loadweave.operators.features import (
    build_features,
    build_features_online_compat,
    build_interval,
    feature_names,
    telling_columns,
)
from loadweave.session import scratch_path
from loadweave.settings import PanelSpec, Settings
from tests.helpers import RAMP, SIX, noisy, ramp, same


def test_names_and_counts():
    names = feature_names(SIX)
    assert len(names) == len(set(names)) == 65
    assert names[:2] == ["pjme_lag_1", "pjme_lag_2"] and names[25] == "pjme_lag_168"
    assert names[26:28] == ["pjmw_lag_1", "pjmw_lag_24"]
    assert names[-2:] == ["pjme_to_pjmw_ratio", "pjme_to_total_ratio"]
    five = PanelSpec(target="a", others=("b", "c", "d", "e"))
    assert len(feature_names(five)) == 62


def test_ramp_values(spark):
    """On a ramp every feature has a closed form."""
    made = build_features(ramp(spark, 200), SIX, keep=("sequence_id",))
    assert made.columns == ["panel_id", "ts", "sequence_id", *feature_names(SIX), "target"]
    rows = {r.sequence_id: r.asDict() for r in made.collect()}
    assert sorted(rows) == list(range(168, 199))
    row, t = rows[180], 180
    at = lambda z, k: RAMP[z][0] + RAMP[z][1] * (t - k)
    for k in (1, 24, 48, 168):
        assert row[f"pjme_lag_{k}"] == at("pjme", k)
    assert row["duq_lag_24"] == at("duq", 24)
    for n in (24, 48, 168):
        assert row[f"pjme_roll_mean_{n}h"] == pytest.approx(at("pjme", (n + 1) / 2), rel=1e-12)
        sd = 10.0 * math.sqrt(n * (n + 1) / 12)
        assert row[f"pjme_roll_std_{n}h"] == pytest.approx(sd, rel=1e-9)
    assert row["pjme_roll_min_24h"] == at("pjme", 24)
    assert row["pjme_roll_max_24h"] == at("pjme", 1)
    assert row["aep_roll_mean_24h"] == pytest.approx(at("aep", 12.5))
    assert row["pjme_diff_1h"] == 10.0 and row["pjme_diff_24h"] == 240.0
    assert row["pjme_ratio_24h"] == pytest.approx(at("pjme", 0) / at("pjme", 24))
    total = sum(at(z, 0) for z in RAMP)
    assert row["pjme_to_total_ratio"] == pytest.approx(at("pjme", 0) / total)
    assert row["target"] == at("pjme", -1)
    # 2010-01-08 12:00, a Friday
    assert (row["hour_of_day"], row["day_of_week"], row["month"], row["day_of_year"]) == (12, 4, 1, 8)
    assert row["is_weekend"] == 0.0


def test_online_compat_on_the_ramp(spark):
    made = build_features_online_compat(ramp(spark, 168), SIX, keep=("sequence_id",))
    rows = made.collect()
    assert [r.sequence_id for r in rows] == [167]
    row = rows[0]
    assert row.pjme_lag_1 == 30000 + 10 * 167  # the current row
    assert row.pjme_lag_168 == 30000.0
    assert row.pjme_roll_mean_168h == pytest.approx(30000 + 10 * 83)  # 167 rows
    assert row.pjme_roll_mean_24h == pytest.approx(30000 + 10 * (167 - 12.5))
    assert build_features_online_compat(ramp(spark, 167), SIX).count() == 0


def test_no_leakage(spark):
    """Changing rows after t changes no feature of t."""
    base = noisy(spark, 260)
    later = base.withColumn(
        "pjme", F.when(F.col("sequence_id") > 220, F.col("pjme") * 3).otherwise(F.col("pjme"))
    )
    keep = ("sequence_id",)
    a = build_features(base, SIX, keep=keep, with_target=False).filter("sequence_id <= 220")
    b = build_features(later, SIX, keep=keep, with_target=False).filter("sequence_id <= 220")
    same(a, b, 12)


@pytest.mark.parametrize("policy", ["fallback", "ieee"])
def test_chunks_change_nothing(spark, policy):
    rows = noisy(spark, 900).unionByName(noisy(spark, 180, "q")).unionByName(noisy(spark, 40, "r"))
    same(
        build_features(rows, SIX, policy=policy),
        build_features(rows, SIX, policy=policy, rows_per_chunk=200),
        9,
    )


def test_compat_chunks_change_nothing(spark):
    rows = noisy(spark, 700).unionByName(noisy(spark, 180, "q"))
    same(
        build_features_online_compat(rows, SIX),
        build_features_online_compat(rows, SIX, rows_per_chunk=200),
        9,
    )


def test_null_zone_drops_what_needs_it(spark):
    """Dropping by the telling columns equals dropping by all of them."""
    rows = noisy(spark, 600).withColumn(
        "aep", F.when(F.col("sequence_id") != 300, F.col("aep"))
    ).withColumn("pjme", F.when(F.col("sequence_id") != 350, F.col("pjme")))
    every = build_features(rows, SIX, drop=False)
    by_all = every.dropna(subset=[*feature_names(SIX), "target"])
    same(build_features(rows, SIX), by_all, 12)
    assert 0 < by_all.count() < 600 - 169
    assert set(telling_columns(SIX)) <= set(feature_names(SIX))


def test_other_windows(spark):
    """Windows that are no multiple of a block use a plain frame."""
    settings = Settings(target_windows=(10, 48), target_lags=(1, 5, 60), cross_windows=(7,))
    made = build_features(noisy(spark, 120), SIX, settings, keep=("sequence_id",))
    rows = {r.sequence_id: r for r in noisy(spark, 120).collect()}
    got = made.filter("sequence_id = 100").first()
    past = [rows[i].pjme for i in range(90, 100)]
    mean = sum(past) / 10
    assert got.pjme_roll_mean_10h == pytest.approx(mean)
    sd = math.sqrt(sum((v - mean) ** 2 for v in past) / 9)
    assert got.pjme_roll_std_10h == pytest.approx(sd)
    wide = [rows[i].pjme for i in range(52, 100)]
    mean = sum(wide) / 48
    sd = math.sqrt(sum((v - mean) ** 2 for v in wide) / 47)
    assert got.pjme_roll_std_48h == pytest.approx(sd)
    assert got.pjme_lag_60 == rows[40].pjme


@pytest.mark.parametrize(
    "policy,target,other,expected",
    [
        ("fallback", 5.0, 0.0, 1.0),
        ("ieee", 5.0, 0.0, math.inf),
        ("ieee", -5.0, 0.0, -math.inf),
        ("ieee", 0.0, 0.0, None),
        ("null", 5.0, 0.0, None),
        ("null", 6.0, 3.0, 2.0),
    ],
)
def test_ratio(spark, policy, target, other, expected):
    from loadweave.functions.expressions import ratio

    df = spark.createDataFrame([(target, other)], "a double, b double")
    assert df.select(ratio(F.col("a"), F.col("b"), policy)).first()[0] == expected


def test_empty_and_short(spark):
    assert build_features(ramp(spark, 0), SIX).count() == 0
    assert build_features(ramp(spark, 169), SIX).count() == 0
    assert build_features(ramp(spark, 170), SIX).count() == 1


def test_interval_equals_the_filtered_matrix_and_reads_a_range(spark):
    rows = noisy(spark, 900).unionByName(noisy(spark, 300, "q")).unionByName(noisy(spark, 350, "r"))
    rows = rows.filter("panel_id != 'q' or sequence_id % 3 != 1")  # a panel with gaps reaches further back
    path = scratch_path(spark, "panel")
    rows.repartition(3).sortWithinPartitions("ts").write.parquet(path)
    stored = spark.read.parquet(path)
    start, end = "2010-01-12 05:00:00", "2010-01-15 05:00:00"
    got = build_interval(stored, SIX, start, end, keep=("sequence_id",))
    want = build_features(rows, SIX, keep=("sequence_id",)).filter(f"ts between '{start}' and '{end}'")
    assert want.count() > 100
    same(got, want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2010-01" in plan and "LessThanOrEqual(ts,2010-01-15T06:00" in plan
    early = build_interval(stored, SIX, "2009-01-01 00:00:00", "2009-02-01 00:00:00")
    assert early.count() == 0
