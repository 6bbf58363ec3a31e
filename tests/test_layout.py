"""Chunked windows give the same values as plain windows, however skewed the data."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadweave.plans.layout import lay_out, running


def series(spark, n_hot=5000, n_small=300):
    """One hot panel with a dense burst, one even panel, one short panel."""
    hot = spark.range(n_hot).select(
        F.lit("hot").alias("p"),
        # nine tenths of the rows within one second, the rest over a month
        F.when(F.col("id") % 10 == 0, F.col("id") * 500_000_000)
        .otherwise(F.lit(1_000_000_000_000) + F.col("id") * 200)
        .alias("us"),
        "id",
    )
    even = spark.range(n_small).select(
        F.lit("even").alias("p"), (F.col("id") * 3_600_000_000).alias("us"), "id"
    )
    short = spark.range(3).select(F.lit("short").alias("p"), F.col("id").alias("us"), "id")
    rows = hot.unionByName(even).unionByName(short)
    return rows.select(
        "p",
        F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"),
        "id",
        ((F.col("id") * 7919) % 1000).cast("double").alias("v"),
    )


def feature_frame(layout):
    w = layout.window
    before = w.rowsBetween(-168, -1)
    return layout.core(
        layout.df.select(
            "*",
            F.lag("v", 168).over(w).alias("lag168"),
            F.lead("v", 1).over(w).alias("next"),
            F.round(F.avg("v").over(before), 9).alias("mean"),
            F.count("v").over(before).alias("n"),
            layout.position().alias("pos"),
        )
    )


@pytest.mark.parametrize("chunk", [100, 1000])
def test_chunked_equals_plain(spark, chunk):
    df = series(spark)
    plain = lay_out(df, ["p"], ["ts"], 168, 1)
    cut = lay_out(df, ["p"], ["ts"], 168, 1, rows_per_chunk=chunk)
    assert not plain.split and cut.split
    a = {tuple(r) for r in feature_frame(plain).collect()}
    rows = feature_frame(cut).collect()
    assert len(rows) == df.count()
    assert {tuple(r) for r in rows} == a


def test_chunks_are_bounded(spark):
    df = series(spark)
    cut = lay_out(df, ["p"], ["ts"], 0, 0, rows_per_chunk=500)
    biggest = cut.df.groupBy(*cut.group).count().agg(F.max("count")).first()[0]
    assert biggest <= 750
    assert cut.df.count() == df.count()


def test_equal_timestamps_are_cut_by_the_next_key(spark):
    df = spark.range(4000).select(
        F.lit("p").alias("p"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
        "id",
    )
    cut = lay_out(df, ["p"], ["ts", "id"], rows_per_chunk=100)
    got = cut.core(cut.df.withColumn("pos", cut.position()))
    assert got.filter("pos != id").count() == 0
    biggest = cut.df.groupBy(*cut.group).count().agg(F.max("count")).first()[0]
    assert biggest <= 150


@pytest.mark.parametrize("kind", ["sum", "max"])
def test_running_over_chunks(spark, kind):
    df = series(spark)
    plain = lay_out(df, ["p"], ["ts"])
    cut = lay_out(df, ["p"], ["ts"], rows_per_chunk=300)
    a = running(plain, plain.df, {"r": "v"}, kind)
    b = cut.core(running(cut, cut.df, {"r": "v"}, kind))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_order_of_rows_is_exact(spark):
    df = series(spark)
    cut = lay_out(df, ["p"], ["ts"], rows_per_chunk=64)
    got = cut.with_size(cut.df.withColumn("pos", cut.position()))
    got = cut.core(got)
    w = Window.partitionBy("p").orderBy("ts")
    bad = got.withColumn("rn", F.row_number().over(w) - 1).filter("rn != pos")
    assert bad.count() == 0
    sizes = {r.p: r._n for r in got.select("p", "_n").distinct().collect()}
    assert sizes == {"hot": 5000, "even": 300, "short": 3}


def test_empty_input(spark):
    df = series(spark).filter("false")
    assert lay_out(df, ["p"], ["ts"], 168, 1).df.count() == 0
