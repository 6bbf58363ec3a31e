from pyspark.sql import functions as F

from loadweave.settings import PanelSpec

SIX = PanelSpec(target="pjme", others=("pjmw", "aep", "dayton", "dom", "duq"))
# Base and step of each zone's ramp.
RAMP = {
    "pjme": (30000.0, 10.0),
    "pjmw": (8000.0, 5.0),
    "aep": (15000.0, 7.0),
    "dayton": (2500.0, 2.0),
    "dom": (12000.0, 6.0),
    "duq": (1800.0, 1.0),
}


def hourly(spark, n, start="2010-01-01 00:00:00", panel="p"):
    """sequence_id 0..n-1 with hourly timestamps."""
    first = F.lit(start).cast("timestamp_ntz")
    return spark.range(n).select(
        F.lit(panel).alias("panel_id"),
        F.col("id").alias("sequence_id"),
        F.timestamp_add("HOUR", F.col("id"), first).alias("ts"),
    )


def ramp(spark, n, panel="p"):
    """Every zone rises by its step each hour."""
    zones = [(F.lit(b) + F.col("sequence_id") * s).alias(z) for z, (b, s) in RAMP.items()]
    return hourly(spark, n, panel=panel).select("*", *zones)


def noisy(spark, n, panel="p", seed=1):
    """Values that follow no line, a function of the row alone."""
    zones = [
        (F.lit(b) + F.pmod(F.xxhash64(F.lit(z), F.lit(panel), "sequence_id", F.lit(seed)), F.lit(5000)) / 7.0).alias(z)
        for z, (b, _) in RAMP.items()
    ]
    return hourly(spark, n, panel=panel).select("*", *zones)


def same(a, b, digits=6):
    """Equal rows, doubles to ``digits`` decimals."""

    def shown(df):
        cols = [F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
        return df.select(*cols)

    a, b = shown(a), shown(b)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
