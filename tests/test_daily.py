"""Reshape, daily roll-ups and facts on hand-made rows (FIXTURES.md §3)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stratocast.functions.scalar import kelvin_to_fahrenheit
from stratocast.operators import daily as D
from stratocast.operators import facts as J
from stratocast.operators import reshape as R
from stratocast.sources import csv_wide as CSV

T0 = dt.datetime(2017, 10, 31, 0, 0, 0)


def _ts(h):
    return T0 + dt.timedelta(hours=h)


def test_unpivot_drops_missing_and_keeps_spaced_names(spark):
    wide = spark.createDataFrame(
        [(_ts(0), 1.0, None, None), (_ts(1), 2.0, 5.0, None)],
        "datetime timestamp_ntz, Boston double, `New York` double, Empty double",
    )
    long = R.wide_to_long(wide, "pressure")
    rows = sorted((r.city, r.pressure) for r in long.collect())
    assert rows == [("Boston", 1.0), ("Boston", 2.0), ("New York", 5.0)]
    assert long.columns == ["datetime", "city", "pressure"]


def test_unpivot_passes_tables_without_datetime(spark):
    cities = spark.createDataFrame([("Boston", "United States", 42.3, -71.0)], "City string, Country string, Latitude double, Longitude double")
    assert R.wide_to_long(cities, "x").collect() == cities.collect()


def test_parse_datetime_strict_and_quarantine(spark):
    df = spark.createDataFrame([("2017-10-31 00:00:00",), ("2017-10-31",)], "datetime string")
    quarantined = R.parse_datetime(df, strict=False).collect()
    assert quarantined[0][0] == dt.datetime(2017, 10, 31) and quarantined[1][0] is None
    with pytest.raises(Exception):
        R.parse_datetime(df, strict=True).collect()


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_files_with_different_city_order_map_by_name(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "input_2017-10-31", "temperature")
    _write(os.path.join(folder, "a.csv"), "datetime,Boston,Miami\n2017-10-31 00:00:00,280.0,300.0\n")
    _write(os.path.join(folder, "b.csv"), "datetime,Miami,Boston\n2017-10-31 01:00:00,301.0,281.0\n")
    long = CSV.read_day(spark, scratch_dir, "2017-10-31", "temperature")
    got = sorted((r.city, r.datetime.hour, r.temperature) for r in long.collect())
    assert got == [("Boston", 0, 280.0), ("Boston", 1, 281.0), ("Miami", 0, 300.0), ("Miami", 1, 301.0)]


def test_csv_missing_markers_and_garbage(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "input_2017-11-01", "humidity")
    _write(os.path.join(folder, "a.csv"), "datetime,A,B,C,D\n2017-11-01 00:00:00,,NA,NaN,40\n")
    long = CSV.read_day(spark, scratch_dir, "2017-11-01", "humidity")
    assert [(r.city, r.humidity) for r in long.collect()] == [("D", 40.0)]
    bad = os.path.join(scratch_dir, "input_2017-11-02", "humidity")
    _write(os.path.join(bad, "a.csv"), "datetime,A\n2017-11-02 00:00:00,abc\n")
    with pytest.raises(Exception):
        CSV.read_day(spark, scratch_dir, "2017-11-02", "humidity").collect()


def test_text_attribute_keeps_strings(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "input_2017-10-31", "weather_description")
    _write(os.path.join(folder, "a.csv"), "datetime,Boston,Miami\n2017-10-31 00:00:00,light rain,\n")
    rows = CSV.read_day(spark, scratch_dir, "2017-10-31", "weather_description").collect()
    assert [(r.city, r.weather_description) for r in rows] == [("Boston", "light rain")]


def test_daily_temperature_min_mean_max(spark):
    rows = [(_ts(0), "A", 273.15), (_ts(1), "A", 283.15), (_ts(2), "A", 293.15), (_ts(25), "A", 300.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, city string, temperature double")
    out = {r.date: r for r in D.daily_temperature(df).collect()}
    day1 = out[dt.date(2017, 10, 31)]
    assert (day1.min_temperature, day1.temperature, day1.max_temperature) == (32.0, 50.0, 68.0)
    assert out[dt.date(2017, 11, 1)].temperature == 80.0


def test_daily_one_day_filter(spark):
    rows = [(_ts(0), "A", 1.0), (_ts(30), "A", 5.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, city string, pressure double")
    out = D.daily_pressure(df, day="2017-11-01").collect()
    assert [(r.date, r.pressure) for r in out] == [(dt.date(2017, 11, 1), 5.0)]


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_first_direction_of_day(spark, method):
    rows = [(_ts(5), "A", 100.0), (_ts(1), "A", 10.0), (_ts(3), "A", 200.0), (_ts(2), "B", 300.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, city string, wind_direction double").repartition(3)
    out = sorted((r.city, r.wind_direction) for r in D.daily_direction(df, method=method).collect())
    assert out == [("A", "North"), ("B", "NorthWest")]


def test_first_direction_with_struct_order(spark):
    rows = [(_ts(0), 2, "A", 100.0), (_ts(0), 1, "A", 200.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, seq long, city string, wind_direction double")
    out = D.daily_direction(df, order_by=("datetime", "seq")).collect()
    assert [r.wind_direction for r in out] == ["South"]


def _dim(spark):
    return spark.createDataFrame(
        [("A", "United States", 1.0, 2.0), ("B", "Canada", 3.0, 4.0), ("C", "Mexico", 5.0, 6.0), ("A", "Canada", 7.0, 8.0)],
        "city string, country string, latitude double, longitude double",
    )


def _readings(spark):
    # A has every measure on day 0; B misses pressure on day 0; C is outside the countries.
    rows = []
    for city in ("A", "B", "C"):
        for h in (0, 1, 24):
            rows.append((_ts(h), city, 280.0 + h, 50.0, 3.0, None, None, None))
            if not (city == "B" and h < 24):
                rows.append((_ts(h), city, None, None, None, 1000.0 + h, 10.0 * h, h))
    return spark.createDataFrame(
        rows,
        "datetime timestamp_ntz, city string, temperature double, humidity double, wind_speed double, "
        "pressure double, wind_direction double, seq long",
    )


SPECS = (
    D.DailySpec("temperature", "temperature", kelvin_to_fahrenheit),
    D.DailySpec("pressure", "pressure"),
    D.DailySpec("humidity", "humidity"),
    D.DailySpec("wind_speed", "wind_speed"),
)


def _join_form(spark, readings, countries):
    line = readings.where(F.col("temperature").isNotNull())
    order = readings.where(F.col("pressure").isNotNull())
    return J.join_fact_direction(
        _dim(spark),
        D.daily_temperature(line),
        D.daily_pressure(order),
        D.daily_humidity(line),
        D.daily_wind_speed(line),
        D.daily_direction(order, order_by=("seq",)),
        countries,
    )


def test_fact_join_semantics(spark):
    fact = _join_form(spark, _readings(spark), ("United States", "Canada")).collect()
    keys = sorted((r.city, r.country, r.date.day) for r in fact)
    # B misses pressure on day 31 -> dropped; C filtered; A fans out to 2 countries.
    assert keys == [("A", "Canada", 1), ("A", "Canada", 31), ("A", "United States", 1), ("A", "United States", 31), ("B", "Canada", 1)]


def test_one_pass_fact_equals_join_fact(spark):
    readings = _readings(spark)
    countries = ("United States", "Canada")
    joined = _join_form(spark, readings, countries)
    one = J.fact_from_readings(_dim(spark), readings, SPECS, countries, J.FACT_DIRECTION_COLUMNS, ("seq",))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, one.collect()))


def test_keyed_fact_equals_join_fact(spark):
    readings = _readings(spark)
    countries = ("United States", "Canada")
    joined = _join_form(spark, readings, countries)
    lines = readings.where(F.col("temperature").isNotNull()).withColumn("key", F.col("datetime"))
    orders = readings.where(F.col("pressure").isNotNull()).withColumn("key", F.col("datetime"))
    line_specs = [s for s in SPECS if s.out != "pressure"]
    parts = D.partials(lines, ["key", "city"], line_specs)
    rows = orders.select("key", "datetime", "city", "seq", "pressure", "wind_direction").join(parts, ["key", "city"], "full")
    rows = rows.withColumn("datetime", F.coalesce("datetime", "key"))
    pressure = [s for s in SPECS if s.out == "pressure"]
    keyed = J.fact_from_keyed(_dim(spark), rows, line_specs, pressure, countries, J.FACT_DIRECTION_COLUMNS, ("seq",))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, keyed.collect()))


def test_invariant_min_le_mean_le_max(spark):
    readings = _readings(spark).where(F.col("temperature").isNotNull())
    bad = D.daily_temperature(readings).where(
        (F.col("min_temperature") > F.col("temperature")) | (F.col("temperature") > F.col("max_temperature"))
    )
    assert bad.count() == 0


def test_first_direction_next_to_every_reading(spark):
    rows = [(_ts(5), "A", 100.0), (_ts(1), "A", 10.0), (_ts(3), "A", 200.0), (_ts(26), "A", 300.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, city string, wind_direction double")
    out = sorted((r.datetime.hour, r.direction, r.direction_of_wind) for r in D.with_first_direction(df).collect())
    assert out == [(1, "North", "North"), (2, "NorthWest", "NorthWest"), (3, "South", "North"), (5, "East", "North")]


def test_csv_header_mismatch_fails_without_header_check(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "input_2017-10-31", "temperature")
    _write(os.path.join(folder, "a.csv"), "datetime,Boston,Miami\n2017-10-31 00:00:00,280.0,300.0\n")
    _write(os.path.join(folder, "b.csv"), "datetime,Miami,Boston\n2017-10-31 01:00:00,301.0,281.0\n")
    with pytest.raises(Exception):
        CSV.read_day(spark, scratch_dir, "2017-10-31", "temperature", check_headers=False).collect()


def test_full_load_equals_union_of_daily_loads(spark):
    from functools import reduce

    from stratocast.sources import standin as S

    readings = S.event_readings(spark, "/root/testdata/sf0.001", "temperature")
    days = sorted(r[0] for r in readings.select(F.to_date("datetime")).distinct().collect())
    full = D.daily_temperature(readings)
    per_day = reduce(lambda a, b: a.unionByName(b), [D.daily_temperature(readings, day=d) for d in days])
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, per_day.collect()))


def test_union_of_staging_tables_feeds_the_one_shuffle_fact(spark):
    readings = _readings(spark)
    countries = ("United States", "Canada")
    tables = {
        a: readings.where(F.col(a).isNotNull()).select("datetime", "city", *(["seq"] if a == "wind_direction" else []), a)
        for a in ("temperature", "pressure", "humidity", "wind_speed", "wind_direction")
    }
    stacked = J.union_readings(tables)
    assert set(stacked.columns) == {"datetime", "city", "seq", "temperature", "pressure", "humidity", "wind_speed", "wind_direction"}
    one = J.fact_from_readings(_dim(spark), stacked, SPECS, countries, J.FACT_DIRECTION_COLUMNS, ("seq",))
    joined = _join_form(spark, readings, countries)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, one.collect()))


def test_readings_that_are_no_numbers_or_far_off(spark):
    """NaN and infinity are missing readings in mean, min and max alike; no
    reading is too large; the mean is never outside min and max."""
    nan, inf = float("nan"), float("inf")
    cases = {
        "nan": [8.0, nan],
        "inf": [8.0, inf, -inf, 2.0],
        "only": [nan, inf],
        "far": [1e20, 1e20],
        "close": [0.49999999999999, 0.5],
        "below": [0.49999999999999994] * 3,
        "tenths": [0.1] * 10,
        "large": [1e300, 3.0],
    }
    want = {
        "nan": (8, 8, 8),
        "inf": (5, 2, 8),
        "only": (None, None, None),
        "far": (1e20, 1e20, 1e20),
        "close": (0, 0, 1),
        "below": (0, 0, 0),
        "tenths": (0, 0, 0),
        "large": (5e299, 3, 1e300),
    }
    rows = [(dt.datetime(2020, 1, 1, 5), k, v) for k, vs in cases.items() for v in vs]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, city string, pressure double").repartition(5)
    whole = {r.city: (r.pressure, r.min_pressure, r.max_pressure) for r in D.daily_pressure(df).collect()}
    assert whole == want
    spec = D.DailySpec("pressure", "pressure")
    parts = D.partials(df, ["city", F.spark_partition_id().alias("part")], [spec])
    merged = parts.groupBy("city").agg(*D.merge_partials([spec])).collect()
    assert {r.city: (r.pressure, r.min_pressure, r.max_pressure) for r in merged} == want
    assert {r.city: r._n_pressure for r in merged} == {k: sum(abs(v) < inf for v in vs) for k, vs in cases.items()}


def test_a_measure_without_proper_readings_makes_no_fact_row(spark):
    at = dt.datetime(2020, 1, 1, 5)
    rows = [(at, "A", 1.0, 2.0), (at, "B", float("nan"), 2.0), (at, "C", 1.0, None)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, city string, humidity double, pressure double")
    dim = spark.createDataFrame([(c, "X", 0.0, 0.0) for c in "ABC"], "city string, country string, latitude double, longitude double")
    specs = [D.DailySpec("humidity", "humidity"), D.DailySpec("pressure", "pressure")]
    out = J.fact_from_readings(dim, df, specs, None, ["city", "humidity", "pressure"])
    assert [tuple(r) for r in out.collect()] == [("A", 1.0, 2.0)]
