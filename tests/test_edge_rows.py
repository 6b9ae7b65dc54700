"""Hand rows for what plain inputs may hold: null keys, dotted names, other
column orders, doubled periods, missing and shrunken day folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_incremental import _cities, _day_files, _snapshot, _write

from stratocast.operators import daily as D
from stratocast.operators import forecast as FC
from stratocast.operators import reshape as R
from stratocast.operators import topn as T
from stratocast.plans import incremental as INC
from stratocast.sources import csv_wide as CSV

T0 = dt.datetime(2020, 1, 1)


def test_readings_of_a_null_city_or_date_stay(spark):
    rows = [(T0, "A", 10.0), (T0.replace(hour=1), "A", 100.0), (T0, None, 200.0), (None, "A", 300.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, city string, wind_direction double")
    out = {(r.city, r.datetime): r.direction_of_wind for r in D.with_first_direction(df).collect()}
    assert len(out) == 4
    assert out[("A", T0.replace(hour=1))] == "North" and out[(None, T0)] == "South" and out[("A", None)] == "NorthWest"


def test_first_direction_with_null_and_huge_order_keys(spark):
    rows = [(T0, "A", None, 100.0), (T0, "A", 2**62, 200.0), (T0, "B", None, 300.0), (T0, "C", -(2**62), 100.0), (T0, "C", 5, 10.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, city string, seq long, wind_direction double")
    want = {"A": "South", "B": "NorthWest", "C": "East"}
    for method in ("aggregate", "window"):
        out = D.daily_direction(df, order_by=("seq",), method=method)
        assert {r.city: r.wind_direction for r in out.collect()} == want, method


def test_city_names_with_dots(spark):
    wide = spark.createDataFrame([(T0, 1.0, 2.0), (T0.replace(hour=1), None, 4.0)], ["datetime", "St. Louis", "Bern"])
    got = sorted((r.city, r.t) for r in R.wide_to_long(wide, "t").collect())
    assert got == [("Bern", 2.0), ("Bern", 4.0), ("St. Louis", 1.0)]


def test_city_file_by_header(spark, scratch_dir):
    _write(os.path.join(scratch_dir, "a.csv"), "Country,City,Longitude,Latitude\nCanada,Toronto,-79.4,43.7\n")
    _write(os.path.join(scratch_dir, "b.csv"), "City,Country,Latitude,Longitude\nBoston,United States,42.4,-71.1\n")
    got = sorted(map(tuple, CSV.read_city_attributes(spark, scratch_dir).collect()))
    assert got == [("Boston", "United States", 42.4, -71.1), ("Toronto", "Canada", 43.7, -79.4)]


def test_headers_are_read_in_one_job(spark, scratch_dir):
    for i in range(12):
        cities = "A,B" if i % 2 else "B,A"
        _write(os.path.join(scratch_dir, f"{i}.csv"), f"datetime,{cities}\n2020-01-01 {i:02d}:00:00,1,2\n")
    groups = CSV._by_header(spark, CSV.list_csv_files(spark, scratch_dir))
    assert {h: len(f) for h, f in groups.items()} == {("datetime", "A", "B"): 6, ("datetime", "B", "A"): 6}


def test_a_period_given_twice_is_an_error(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("a", 3, 5.0)], ["k", "t", "y"])
    for method in ("interpolate", "zero"):
        with pytest.raises(Exception, match="period given twice"):
            FC.fill_missing(df, ["k"], "t", "y", method).collect()


def test_forecast_keys_may_have_any_free_name(spark):
    rows = [("x", i, float(i)) for i in range(1, 7)]
    one = FC.forecast(spark.createDataFrame(rows, ["k", "t", "y"]), ["k"], "t", "y").drop("k").collect()
    for name in ("n", "h", "points"):
        got = FC.forecast(spark.createDataFrame(rows, [name, "t", "y"]), [name], "t", "y").drop(name).collect()
        assert got == one
    with pytest.raises(ValueError, match="model"):
        FC.forecast(spark.createDataFrame(rows, ["model", "t", "y"]), ["model"], "t", "y")


def test_ranking_reads_its_input_once(spark):
    rows = [("a", 1, 9.0), ("a", 2, 1.0), ("b", 1, 4.0), ("c", 2, 8.0)]
    df = spark.createDataFrame(rows, ["city", "m", "temperature"])
    in_month = F.col("m") == 1
    top = lambda **k: [tuple(r) for r in T.top_members(df, "temperature", condition=in_month, **k).collect()]
    assert top(n=2) == [("a", 9.0)]  # c and a lead over all months, c has no row in this one
    assert top(n=2, scope="filtered") == [("a", 9.0), ("b", 4.0)]
    assert top(n=2, end="bottom") == [("b", 4.0), ("a", 9.0)]
    assert top(n=3, end="bottom", value="range", rank_by="range") == [("a", 0.0), ("b", 0.0)]
    plan = T.top_members(df, "temperature", 2, condition=in_month)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def _layout(scratch_dir):
    return os.path.join(scratch_dir, "raw"), INC.Layout(os.path.join(scratch_dir, "raw"), os.path.join(scratch_dir, "wh"))


def test_a_missing_folder_stops_the_day(spark, scratch_dir):
    raw, layout = _layout(scratch_dir)
    day = dt.date(2017, 11, 1)
    with pytest.raises(FileNotFoundError):
        INC.run_day(spark, layout, day=day)
    _day_files(raw, day)
    os.rename(os.path.join(raw, "input_2017-11-01", "wind_speed"), os.path.join(scratch_dir, "elsewhere"))
    with pytest.raises(FileNotFoundError):
        INC.run_day(spark, layout, day=day)
    assert INC.next_day(spark, layout.ledger) == dt.date(2017, 10, 31)
    assert not os.path.exists(layout.staging("temperature"))


def test_an_unreadable_ledger_is_an_error(spark, scratch_dir):
    _write(os.path.join(scratch_dir, "ledger", "part-0.parquet"), "no parquet")
    with pytest.raises(Exception):  # noqa: B017
        INC.next_day(spark, os.path.join(scratch_dir, "ledger"))


def test_a_rerun_replaces_a_shrunken_folder(spark, scratch_dir):
    raw, layout = _layout(scratch_dir)
    d1, d2 = dt.date(2017, 10, 31), dt.date(2017, 11, 1)
    _cities(raw, d1)
    _day_files(raw, d1)
    INC.run_day(spark, layout, day=d1)
    before = _snapshot(spark, layout, "daily_pressure")
    _day_files(raw, d2, late="2017-10-20")
    assert INC.run_day(spark, layout, day=d2)["touched"] == [dt.date(2017, 10, 20), d2]
    _day_files(raw, d2)  # corrected: the reading of 10-20 was wrong
    assert INC.run_day(spark, layout, day=d2)["touched"] == [dt.date(2017, 10, 20), d2]
    after = _snapshot(spark, layout, "daily_pressure")
    assert {r[-1] for r in after} == {d1, d2} and [r for r in after if r[-1] == d1] == before
    assert spark.read.parquet(layout.staging("pressure")).where("date = '2017-10-20'").count() == 0
    assert not os.path.exists(layout.pending)


def test_two_sessions_keep_their_overwrite_mode(spark, scratch_dir):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    _, layout = _layout(scratch_dir)
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "v int, date date")
    INC.write_partitioned(df, layout.aggregate("t"))
    INC.write_partitioned(df.withColumn("date", F.date_add("date", 1)), layout.aggregate("t"))
    assert spark.read.parquet(layout.aggregate("t")).count() == 2
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
