"""Scalar functions P1-P11 on hand-made rows (FIXTURES.md §3)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stratocast.functions import scalar as P


def _one_col(spark, values, expr, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_kelvin_to_fahrenheit(spark):
    out = _one_col(spark, [273.15, 0.0, 300.0], P.kelvin_to_fahrenheit)
    assert abs(out[0] - 32.0) < 1e-9
    assert abs(out[1] - (-459.67)) < 1e-9
    assert abs(out[2] - 80.33) < 1e-9


def test_rounding_modes(spark):
    assert _one_col(spark, [2.5, -2.5, 0.5], lambda c: P.round_half(c, 0)) == [3.0, -3.0, 1.0]
    assert _one_col(spark, [2.5, -2.5, 0.5], lambda c: P.round_half(c, 0, "half_even")) == [2.0, -2.0, 0.0]


def test_rounding_happens_once(spark):
    vals = [71.5, 71.4999997, 71.49999999999999, -0.5]
    assert _one_col(spark, vals, lambda c: P.round_half(c, 0)) == [72.0, 71.0, 71.0, -1.0]


def test_exact_mean_has_no_order(spark):
    from pyspark.sql import functions as F

    vals = [0.1] * 10 + [1e5, -1e5, 71.5]
    for order in (vals, vals[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(3)
        got = df.agg(P.exact_mean(P.exact_sum("v"), F.count("v")).alias("m")).first().m
        assert got == 72.5 / 13
    assert df.where("v > 1e9").agg(P.exact_mean(P.exact_sum("v"), F.count("v")).alias("m")).first().m is None


def test_exact_sum_is_exact_and_has_no_order(spark):
    """Against Python's exactly rounded sum, over shuffled partitions."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    for scale in (1e-9, 1.0, 1e4, 1e12):
        vals = [rng.uniform(-1, 1) * scale + rng.choice([0, 273.15, -40]) for _ in range(500)]
        want, seen = math.fsum(vals) / len(vals), set()
        for parts in (1, 3, 7):
            rng.shuffle(vals)
            df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(parts)
            total = df.agg(P.exact_mean(P.exact_sum("v"), F.count("v")).alias("m"))
            halves = df.groupBy(F.spark_partition_id()).agg(P.exact_sum("v").alias("s"), F.count("v").alias("n"))
            again = halves.agg(P.exact_mean(P.merged_sum("s"), F.sum("n")).alias("m"))
            seen |= {total.first().m, again.first().m}
        assert len(seen) == 1 and abs(seen.pop() - want) <= 2.0 * math.ulp(abs(want) + 1)


def test_sums_without_a_range(spark):
    from pyspark.sql import functions as F

    cases = {
        "far": ([1e20, 1.0, -1e20, 3.0], 1.0),
        "huge": ([1e308, -1e308, 2.5], 2.5 / 3),
        "tiny": ([2.0**-60], 0.0),
        "close": ([0.49999999999999, 0.5], 0.499999999999995),
        "odd": ([float("nan"), float("inf"), float("-inf"), 4.0, None], 4.0),
        "none": ([float("nan"), None], None),
    }
    rows = [(k, v) for k, (vs, _) in cases.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    got = df.groupBy("k").agg(P.exact_mean(P.exact_sum("v"), F.count(P.finite("v"))).alias("m")).collect()
    assert {r.k: r.m for r in got} == {k: m if m is None else pytest.approx(m, abs=1e-15) for k, (_, m) in cases.items()}


def test_compass_bounds(spark):
    degrees = [22.5, 22.6, 67.5, 67.6, 112.5, 112.6, 157.5, 157.6, 202.5, 202.6, 247.5, 247.6, 292.5, 292.6, 337.5, 337.6]
    expected = ["North"] + ["NorthEast"] * 2 + ["East"] * 2 + ["SouthEast"] * 2 + ["South"] * 2 + ["SouthWest"] * 2 + [
        "West"
    ] * 2 + ["NorthWest"] * 2 + ["North"]
    assert _one_col(spark, degrees, P.compass) == expected


def test_compass_gaps_and_null_are_north(spark):
    assert _one_col(spark, [22.55, 67.55, 292.55, None, 0.0, 360.0, -1.0], P.compass) == ["North"] * 7


def test_compass_code_round_trip(spark):
    degrees = [0.0, 30.0, 90.0, 130.0, 180.0, 220.0, 260.0, 300.0, 350.0]
    names = _one_col(spark, degrees, P.compass)
    codes = _one_col(spark, degrees, lambda c: P.compass_from_code(P.compass_code(c)))
    assert names == codes


def test_season_per_month(spark):
    days = [dt.date(2017, m, 15) for m in range(1, 13)]
    out = _one_col(spark, days, P.season, "date")
    assert out == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer", "Fall", "Fall", "Fall", "Winter"]


def test_date_buckets_and_order(spark):
    df = spark.createDataFrame([(dt.date(2014, 8, 9),), (dt.date(2014, 12, 31),)], "d date")
    rows = df.select(
        P.date_bucket("d", "year"),
        P.date_bucket("d", "quarter"),
        P.date_bucket("d", "month"),
        P.date_bucket("d", "day"),
        P.month_year("d"),
        P.bucket_order("d", "month"),
    ).collect()
    assert tuple(rows[0]) == ("2014", "Summer", "8", "9", 201408, 8)
    assert tuple(rows[1]) == ("2014", "Winter", "12", "31", 201412, 12)


def test_map_label_and_number_format(spark):
    df = spark.createDataFrame([(-3.0, 71.0, 1234.56)], "lo double, hi double, v double")
    row = df.select(P.map_label("lo", "hi"), P.number_format("v", 1)).first()
    assert row[0] == "(-3°F  ,  71°F)"
    assert row[1] == "1,234.6"


def test_to_day(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 10, 31, 23, 59, 59),)], "ts timestamp_ntz")
    assert df.select(P.to_day("ts")).first()[0] == dt.date(2017, 10, 31)


def test_cluster_conf_sizing():
    from stratocast.session import cluster_conf

    conf = cluster_conf(100 * (1 << 40), executors=1000, cores_per_executor=4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409_600  # a partition for each split; AQE coalesces
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120  # 3 per core
