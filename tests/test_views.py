"""Dashboard views Q1-Q9, top-N scopes and aggregates (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from stratocast.operators import measures as A
from stratocast.operators.keys import with_dense_id
from stratocast.plans import views as V
from stratocast.sources.sinks import profile


def _fact(spark):
    # 4 cities; "Hot" is hottest overall but has no row in August 2014.
    rows = []
    for city, country, base, aug in [
        ("Hot", "United States", 90.0, False),
        ("Warm", "United States", 70.0, True),
        ("Mild", "United States", 60.0, True),
        ("Cold", "Canada", 20.0, True),
    ]:
        for day in (dt.date(2014, 7, 1), dt.date(2014, 8, 1), dt.date(2014, 8, 2)):
            if day.month == 8 and not aug:
                continue
            bump = 10.0 if (city == "Mild" and day.day == 2) else 0.0
            rows.append((day, country, city, 1.0, 2.0, base + bump, 1000.0, 50.0, 5.0, "North"))
    return spark.createDataFrame(
        rows,
        "date date, country string, city string, latitude double, longitude double, temperature double, "
        "pressure double, humidity double, wind_speed double, wind_direction string",
    )


def test_average_and_range_one_row(spark):
    f = _fact(spark)
    assert V.average_value(f, "Temperature", 201408, "United States").first().value == (70 + 70 + 60 + 70) / 4
    assert V.range_value(f, "Temperature", 201408, "United States").first().value == 10.0
    empty = V.average_value(f, "Temperature", 199901, "United States").collect()
    assert len(empty) == 1 and empty[0].value is None


def test_measure_parameter_spellings(spark):
    f = _fact(spark)
    a = V.average_value(f, "Wind Speed", 201408, "United States").first().value
    b = V.average_value(f, "wind speed", 201408, "United States").first().value
    assert a == b == 5.0


def test_top_scope_global_vs_filtered(spark):
    f = _fact(spark)
    glob = V.top_cities(f, "Temperature", 2, "top", 201408, "United States", "global").collect()
    filt = V.top_cities(f, "Temperature", 2, "top", 201408, "United States", "filtered").collect()
    # global: top 2 overall are Hot and Warm; Hot has no August row -> one city shown
    assert [r.city for r in glob] == ["Warm"]
    assert [r.city for r in filt] == ["Warm", "Mild"]


def test_bottom_and_consistent_rank_by(spark):
    f = _fact(spark)
    bottom = V.top_cities(f, "Temperature", 2, "bottom", 201408, None, "global").collect()
    assert [r.city for r in bottom] == ["Cold", "Mild"]
    by_avg = V.consistent_cities(f, "Temperature", 2, 201408, None, "filtered", "average").collect()
    by_range = V.consistent_cities(f, "Temperature", 2, 201408, None, "filtered", "range").collect()
    assert sorted(r.city for r in by_avg) == ["Cold", "Mild"]
    assert sorted(r.city for r in by_range) == ["Cold", "Warm"]


def test_map_data(spark):
    rows = V.map_data(_fact(spark), "Temperature", 201408, "Canada").collect()
    assert [(r.city, r.latitude, r.longitude, r.value) for r in rows] == [("Cold", 1.0, 2.0, 20.0)]


def _range_fact(spark):
    rows = [
        (dt.date(2014, m, 1), "C1", "X", 0.0, 0.0, float(m), float(m) - 1, float(m) + 1)
        for m in (1, 4, 7, 10, 12)
    ]
    return spark.createDataFrame(
        rows,
        "date date, city string, country string, latitude double, longitude double, "
        "temperature double, min_temperature double, max_temperature double",
    )


def test_climate_series_season_buckets(spark):
    rows = V.climate_series(_range_fact(spark), "temperature", "quarter").collect()
    got = {(r.bucket, r.measure_name): r.value for r in rows}
    assert got[("Winter", "maximum")] == 13.0 and got[("Winter", "minimum")] == 0.0
    assert got[("Winter", "average")] == 6.5
    assert {r.measure_order for r in rows if r.measure_name == "maximum"} == {1}


def test_climate_map_cross_filter(spark):
    f = _range_fact(spark)
    chosen = spark.createDataFrame([("Summer",)], "bucket string")
    row = V.climate_map(f, "temperature", "quarter", None, chosen).first()
    assert (row.maximum, row.minimum, row.average, row.label) == (8.0, 6.0, 7.0, "(6°F  ,  8°F)")
    everything = V.climate_map(f, "temperature", "quarter", None, []).first()
    assert everything.maximum == 13.0


def test_drill_rollup_levels(spark):
    rows = A.drill_country_city(_fact(spark)).collect()
    levels = sorted((r.level, r.country or "", r.city or "") for r in rows)
    assert (3, "", "") in levels and (1, "Canada", "") in levels and (0, "Canada", "Cold") in levels


def test_dense_ids(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    out = with_dense_id(df, ["k"], partitions=4).collect()
    assert sorted((r.id, r.k) for r in out) == [(i + 1, i) for i in range(1000)]


def test_profile(spark):
    rows = {r.column_name: r for r in profile(_fact(spark), exact=True).collect()}
    assert rows["city"].distinct_count == 4 and rows["city"].null_count == 0
    assert rows["date"].data_type == "date"
    approx = {r.column_name: r for r in profile(_fact(spark)).collect()}
    assert approx["city"].distinct_count == 4


def test_dashboards_over_a_snapshot(spark, scratch_dir):
    import os

    from stratocast.plans import dashboards as DB
    from stratocast.plans import weather as W

    sf = "/root/testdata/sf0.001"
    live = W.fact_direction(spark, sf)
    snap = DB.materialise(live, os.path.join(scratch_dir, "fact_direction"))
    assert sorted(map(tuple, snap.collect())) == sorted(map(tuple, live.collect()))
    views = DB.weather_dashboard(snap, "Temperature", 199708, "AMERICA")
    direct = DB.weather_dashboard(live, "Temperature", 199708, "AMERICA")
    assert set(views) == {"average_value", "range_value", "top_cities", "bottom_cities", "consistent_cities", "map_data"}
    for name in views:
        assert sorted(map(tuple, views[name].collect())) == sorted(map(tuple, direct[name].collect()))
    climate = DB.climate_dashboard(DB.materialise(W.fact_range(spark, sf), os.path.join(scratch_dir, "fr")), level="quarter")
    assert climate["climate_series"].count() > 0 and climate["climate_map"].count() > 0
    fc = DB.forecast_dashboard(W.fact_range(spark, sf), ["NATION_1"], (1996, 2000))
    assert fc["forecast"].where("indicator = 'Estimate'").count() == 3


def test_dense_ids_with_a_hot_key(spark):
    # one key value holds half of the rows: ids stay dense and unique
    df = spark.range(0, 2000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    out = with_dense_id(df, ["k"], partitions=4)
    ids = sorted(r.id for r in out.collect())
    assert ids == list(range(1, 2001))
    parts = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 2000
