"""Exact durations, and the KPIs that sum them."""

from datetime import timedelta

from pyspark.sql import functions as F

from ringroster.functions.durations import (
    as_intervals,
    epoch_secs,
    exact_secs,
    hms_text,
    micros,
    no_time_if_null,
    secs_interval,
    time_between,
    time_of_day,
)
from ringroster.operators.aggregates import avg_dur, sum_dur

SPANS = [
    ("2024-01-01 10:00:00.250001", "2024-01-03 10:00:01.5"),
    ("2024-01-01 10:00:00", "2024-01-01 09:59:59.999999"),
    ("2024-01-01 00:00:00", "2024-01-01 00:00:00.000001"),
    (None, "2024-01-01 00:00:00"),
]
WANT = [172_801_249_999, -1, 1, None]


def spans(spark):
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(SPANS)], "i int, a string, b string")
    return df.select("i", time_between(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("d"))


def test_differences_keep_their_fraction(spark, tmp_path):
    df = spans(spark)
    got = df.select("i", micros("d").alias("us"), hms_text(epoch_secs("d")).alias("text")).orderBy("i").collect()
    assert [r.us for r in got] == WANT
    assert [r.text for r in got] == ["48:00:01", "00:00:00", "00:00:00", None]
    df.write.parquet(str(tmp_path / "d"))
    back = spark.read.parquet(str(tmp_path / "d"))
    assert back.schema["d"].dataType == df.schema["d"].dataType
    assert [r.us for r in back.orderBy("i").select(micros("d").alias("us")).collect()] == WANT


def test_sums_and_averages_are_exact(spark):
    # a third of a million fractions that would all be lost in whole seconds
    df = spark.range(0, 300_000, 1, 8).select(secs_interval(F.lit("0.000007").cast("decimal(18,6)") + F.col("id") % 2).alias("d"))
    r = df.agg(sum_dur("d").alias("s"), avg_dur("d").alias("a"), sum_dur("d", F.lit(False)).alias("z"), avg_dur("d", F.lit(False)).alias("y")).first()
    assert r.s == timedelta(seconds=150_000, microseconds=2_100_000)
    assert r.a == timedelta(microseconds=500_007)
    assert r.z == r.y == timedelta(0)


def test_seconds_and_intervals_of_sources_become_intervals(spark):
    df = spark.range(1).select(
        F.lit(90).alias("whole"), F.lit("1.5").cast("decimal(9,3)").alias("part"),
        F.lit(2.25).alias("double"), secs_interval(F.lit(3)).alias("time"), F.lit(None).cast("int").alias("none"),
    )
    got = as_intervals(df, df.columns).first()
    assert list(got) == [timedelta(seconds=s) for s in (90, 1.5, 2.25, 3)] + [None]


def test_time_of_day_drops_whole_days(spark):
    df = spark.createDataFrame([(0.0,), (86_399.5,), (86_400.25,), (200_000.0,), (None,)], "s double").coalesce(1)
    got = df.select(exact_secs(time_of_day(secs_interval("s"))).alias("t"), no_time_if_null(secs_interval("s")).alias("z")).collect()
    assert [None if r.t is None else float(r.t) for r in got] == [0, 86_399.5, 0.25, 27_200, None]
    assert got[-1].z == timedelta(0)
