
from pyspark.sql import functions as F

from merchant_signals.functions.time import ceil15, floor15, next15
from merchant_signals.operators.features import horizon_bounds
from tests.helpers import ts


def test_bucket_goldens(spark):
    rows = [("2024-01-01 10:00:00",), ("2024-01-01 10:00:00.000001",), ("2024-01-01 10:14:59.999999",)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp").alias("t"))
    out = {r["t"]: (r["f"], r["c"], r["n"]) for r in
           df.select("t", floor15("t").alias("f"), ceil15("t").alias("c"), next15("t").alias("n")).collect()}
    assert out[ts("2024-01-01 10:00:00")] == (ts("2024-01-01 10:00"), ts("2024-01-01 10:00"), ts("2024-01-01 10:15"))
    assert out[ts("2024-01-01 10:00:00.000001")] == (ts("2024-01-01 10:00"), ts("2024-01-01 10:15"),
                                                     ts("2024-01-01 10:15"))
    assert out[ts("2024-01-01 10:14:59.999999")] == (ts("2024-01-01 10:00"), ts("2024-01-01 10:15"),
                                                     ts("2024-01-01 10:15"))


def test_pre_epoch_floor(spark):
    df = spark.createDataFrame([("1969-12-31 23:59:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert df.select(floor15("t")).first()[0] == ts("1969-12-31 23:45:00")


def test_horizon_is_six_buckets_ending_at_ceil15():
    lo, hi = horizon_bounds(ts("2024-01-31 00:07:00"))
    assert hi == ts("2024-01-31 00:15:00") and lo == ts("2024-01-30 23:00:00")
    lo, hi = horizon_bounds(ts("2024-01-31 00:00:00"))
    assert hi == ts("2024-01-31 00:00:00") and lo == ts("2024-01-30 22:45:00")
