"""

Every query reads the driver's tables at ``sf_dir`` and derives the weather
data model from them (``stratocast.sources.standin``, FIXTURES.md §4), then
runs the package's operators over the whole tables. ``oracle_sql`` gives the
same computation as plain SQL for DuckDB; column names and types match.
"""

from __future__ import annotations

import datetime
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast.functions import scalar as P
from stratocast.operators import daily as D
from stratocast.operators import facts as J
from stratocast.operators import forecast as FC
from stratocast.operators import keys as KEYS
from stratocast.operators import measures as A
from stratocast.operators import reshape as R
from stratocast.plans import views as V
from stratocast.plans import weather as W
from stratocast.plans.oracle import compass_sql, fahrenheit, mean, rnd, with_ctes
from stratocast.session import checkpoint_root, java_path
from stratocast.sources import csv_wide as CSV
from stratocast.sources import publish as PUB
from stratocast.sources import sinks as SK
from stratocast.sources import standin as S
from stratocast.sources import tables as TAB

# The training-data operators are an optional part: without them everything
# else works. Only their absence is tolerated, no error inside them.
try:
    import corpus_pipeline as PIPELINE
    from stratocast.llm import queries as LLM
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "stratocast.llm"):
        raise
    PIPELINE = LLM = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Stand-in parameters (FIXTURES.md §4)
MONTH = S.STANDIN_MONTH_YEAR  # 199708
COUNTRY = S.STANDIN_COUNTRY  # AMERICA
FORECAST_CITY = S.STANDIN_FORECAST_CITY  # NATION_1
YEARS = S.STANDIN_YEARS  # 1996-2000
ALL_YEARS = (1995, 2001)  # of the orders
ONE_DAY = "2024-01-15"  # a day of the events table (incremental mode)
CHOSEN_YEARS = ["1997", "1998"]  # cross-filter selection for the climate map


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the "top cities" dashboard view over the fact built from
    the sf0.001 tables."""
    return _q3_top(spark, SMOKE_DIR)


# ----------------------------------------------------------------------------
# Spark side
# ----------------------------------------------------------------------------

def _fact_d(spark, d, form="keyed"):
    return W.fact_direction(spark, d, form=form)


def _fact_r(spark, d, form="keyed"):
    return W.fact_range(spark, d, form=form)


def _q3_top(spark, d):
    return V.top_cities(_fact_d(spark, d), "Temperature", 10, "top", MONTH, COUNTRY, "global")


def _scalar_functions(spark, d):
    ev = S.table(spark, d, "events")
    deg = (F.col("value") * F.lit(37)) % F.lit(360)
    return ev.select(
        F.col("event_id"),
        P.to_day("ts").alias("date"),
        P.round_half(P.kelvin_to_fahrenheit("value"), 0).alias("fahrenheit"),
        P.round_half(F.col("value"), 0, "half_even").alias("value_bround"),
        P.compass(deg).alias("direction"),
        P.month_year("ts").cast("long").alias("month_year"),
        P.season("ts").alias("season"),
        P.date_bucket("ts", "year").alias("year_bucket"),
        P.date_bucket("ts", "month").alias("month_bucket"),
        P.date_bucket("ts", "day").alias("day_bucket"),
        P.number_format(F.col("value") * F.lit(1000), 1).alias("value_text"),
    )


def _wide_roundtrip(spark, d):
    ev = S.table(spark, d, "events")
    wide = (
        ev.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"))
        .pivot("event_type")
        .agg(F.round(F.avg("value"), 9))  # hourly mean, independent of summation order
    )
    return R.wide_to_long(wide, "value")


def _wide_seconds(spark, d):
    """The events as wide text rows: one column per event type, text timestamps
    in the original second-precision format, the per-second mean where two
    events share a second."""
    ev = S.table(spark, d, "events")
    return (
        ev.groupBy(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"))
        .pivot("event_type")
        .agg(F.round(F.avg("value"), 9))
    )


def _csv_roundtrip(spark, d):
    """S1 + R1-R3 on the driver's data: Spark writes the events as wide CSV
    folders, those of odd seconds with the columns in another order, then the
    CSV reader stages them back to long readings."""
    wide = _wide_seconds(spark, d)
    root = checkpoint_root(spark, fallback=tempfile.gettempdir())
    folder = os.path.join(root, "csv_roundtrip", uuid.uuid4().hex)
    odd = F.col("datetime").rlike("[13579]$")
    wide.where(~odd).write.option("header", "true").csv(f"{folder}/a")
    wide.where(odd).select(*wide.columns[::-1]).write.option("header", "true").csv(f"{folder}/b")
    return CSV.read_wide(spark, folder, "value")


def _quarantined_lines(spark, d):
    """R3 with a quarantine: the same rows, with timestamps of another format at
    the seconds :07 and a word among the values at :13; the rejected lines'
    timestamps and reasons, and the accepted lines' readings."""
    wide = _wide_seconds(spark, d)
    first = wide.columns[1]
    planted = wide.select(
        F.when(F.col("datetime").endswith(":07"), F.translate("datetime", "-", "/")).otherwise(F.col("datetime")).alias("datetime"),
        F.when(F.col("datetime").endswith(":13"), "broken").otherwise(F.col(f"`{first}`").cast("string")).alias(first),
        *[F.col(f"`{c}`") for c in wide.columns[2:]],
    )
    folder = os.path.join(checkpoint_root(spark, fallback=tempfile.gettempdir()), "quarantine", uuid.uuid4().hex)
    planted.write.option("header", "true").csv(folder)
    good, bad = CSV.read_quarantined(spark, folder, "value")
    rejected = bad.select(F.split("line", ",")[0].alias("datetime"), "reason", F.lit(None).cast("string").alias("city"), F.lit(None).cast("double").alias("value"))
    accepted = good.select(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), F.lit("").alias("reason"), "city", "value")
    return accepted.unionByName(rejected)


def _staged_daily(spark, d, attribute):
    """I4/I6, S4/S5 on the driver's data: events staged (one partitioned
    write, partitions ``date`` / ``load_date``), the daily tables of every
    staged day recomputed and written by the incremental job's aggregate
    step, then read back."""
    from stratocast.plans import incremental as INC

    root = checkpoint_root(spark, fallback=tempfile.gettempdir())
    layout = INC.Layout(raw_root=os.path.join(root, "unused"), warehouse=os.path.join(root, "staged_daily", uuid.uuid4().hex))
    readings = S.event_degrees(spark, d) if attribute == "wind_direction" else S.event_readings(spark, d, attribute)
    staged = readings.withColumn("date", F.to_date("datetime")).withColumn("load_date", F.col("date"))
    INC.write_partitioned_multi(staged, layout.staging(attribute), ["date", "load_date"])
    # the staged days, from the partition listing (one row per day)
    days = sorted(r["date"] for r in spark.read.parquet(layout.staging(attribute)).select("date").distinct().collect())
    tables = INC.aggregate_days(spark, layout, days, [attribute])
    return spark.read.parquet(tables[INC.AGGREGATED[attribute]])


def _event_days(spark, d, *attributes):
    """The events as day folders of wide CSV (one column per event type, as in
    ``csv_roundtrip``), the same for each attribute: the layout and the days."""
    from stratocast.plans import incremental as INC

    root = os.path.join(checkpoint_root(spark, fallback=tempfile.gettempdir()), "event_days", uuid.uuid4().hex)
    layout = INC.Layout(raw_root=os.path.join(root, "raw"), warehouse=os.path.join(root, "warehouse"))
    ev = S.table(spark, d, "events")
    wide = (
        ev.groupBy(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"), F.to_date("ts").alias("day"))
        .pivot("event_type")
        .agg(F.round(F.avg("value"), 9))
    )
    days = set()
    for attribute in attributes:
        flat = os.path.join(root, "flat", attribute)
        wide.hint("rebalance", "day").write.partitionBy("day").option("header", "true").csv(flat)
        fs, at = java_path(spark, flat)
        for folder in PUB.glob(spark, f"{flat}/day=*"):
            day = folder.getName().removeprefix("day=")
            _, target = java_path(spark, f"{layout.raw_root}/input_{day}/{attribute}")
            fs.mkdirs(target.getParent())
            fs.rename(folder, target)
            days.add(datetime.date.fromisoformat(day))
    days = sorted(days)
    return layout, days


def _run_days_daily(spark, d):
    """The events' day folders staged and aggregated
    by the daily job, the daily table read back."""
    from stratocast.plans import incremental as INC

    layout, days = _event_days(spark, d, "temperature")
    done = INC.run_days(spark, layout, days, ["temperature"])
    return spark.read.parquet(done["tables"]["daily_temperature"])


def _run_attributes_daily(spark, d):
    """The folders of two attributes staged in one job; both daily tables."""
    from stratocast.plans import incremental as INC

    layout, days = _event_days(spark, d, "humidity", "temperature")
    tables = INC.run_days(spark, layout, days, ["humidity", "temperature"])["tables"]
    humidity, temperature = (spark.read.parquet(tables[t]) for t in ("humidity_daily_average", "daily_temperature"))
    return humidity.join(temperature, ["date", "city"])


def _catalog_days_daily(spark, d):
    """The same folders taken by the daily job with a database, one day
    run again, the daily table read back by its name."""
    from stratocast.plans import incremental as INC

    plain, days = _event_days(spark, d, "temperature")
    layout = INC.Layout(plain.raw_root, plain.warehouse, database=f"weather_{uuid.uuid4().hex[:12]}")
    INC.run_days(spark, layout, days, ["temperature"])
    INC.run_days(spark, layout, days[:1], ["temperature"])
    return TAB.read_table(spark, SK.table_name(layout.database, "daily_temperature", "spark_catalog"))


def _stream_days_daily(spark, d):
    """ST1/ST2: the same folders taken by the stream."""
    from stratocast.streaming import day_folders as ST

    layout, _ = _event_days(spark, d, "pressure")
    ST.run_available(spark, layout, attributes=("pressure",), checkpoint=os.path.join(layout.warehouse, "stream"))
    return spark.read.parquet(layout.aggregate("daily_pressure"))


def _ledger_days(spark, d):
    """The events' days appended to a ledger; the next day to process."""
    from stratocast.plans import incremental as INC

    root = os.path.join(checkpoint_root(spark, fallback=tempfile.gettempdir()), "ledger", uuid.uuid4().hex)
    days = [r["day"] for r in S.table(spark, d, "events").select(F.to_date("ts").alias("day")).distinct().orderBy("day").collect()]
    INC.append_ledger(spark, root, *days)
    return INC.read_ledger(spark, root).select("seq", "date", F.lit(INC.next_day(spark, root)).alias("next_day"))


def _city_csv(spark, d):
    """The city dimension written as a city file; its folder."""
    root = _scratch(spark, "cities")
    cities = S.cities(spark, d).select(
        F.col("longitude").alias("Longitude"), F.col("city").alias("City"), F.col("country").alias("Country"), F.col("latitude").alias("Latitude")
    )
    cities.write.option("header", "true").csv(root)
    return root


def _city_file(spark, d):
    """The city file read back."""
    return CSV.read_city_attributes(spark, _city_csv(spark, d))


def _city_rows(spark, d):
    """The city file, which has no datetime, through the readings' reader."""
    return CSV.read_wide(spark, _city_csv(spark, d), "city_attributes")


def _snapshot_series(spark, d):
    """A view over a materialised fact snapshot."""
    path = os.path.join(checkpoint_root(spark, fallback=tempfile.gettempdir()), "snapshot", uuid.uuid4().hex)
    SK.write_snapshot(_fact_r(spark, d), path)
    return V.climate_series(spark.read.parquet(path), "temperature", "year")


def _scratch(spark, name):
    return os.path.join(checkpoint_root(spark, fallback=tempfile.gettempdir()), name, uuid.uuid4().hex)


def _profile(spark, d):
    return SK.profile(_fact_d(spark, d), exact=True)


def _profile_sketches(spark, d):
    """S10 by sketches kept for each year: those of all years, then those of one
    year again, merged; distinct counts to two digits, as they are estimates."""
    path = _scratch(spark, "profile")
    fact = _fact_d(spark, d).withColumn("year", F.year("date"))
    SK.refresh_profile(fact, path, "year")
    SK.refresh_profile(fact.where(F.col("year") == YEARS[0]), path, "year")
    kept = SK.stored_profile(spark, path, "year")
    return kept.select("column_name", "data_type", _two_digits("distinct_count").alias("distinct_about"), "null_count", "row_count")


def _two_digits(column):
    unit = F.pow(F.lit(10), F.greatest(F.length(F.col(column).cast("string")) - 2, F.lit(0)))
    return (F.round(F.col(column) / unit) * unit).cast("long")


def _dense_ids_rerun(spark, d):
    """K1 on a stored daily table, one day of which is written again without its
    first city: only that day is written, all later ids move up."""
    path = _scratch(spark, "dense")
    daily = D.daily_temperature(S.event_readings(spark, d, "temperature"))
    KEYS.store_ranked(daily, path, ["city"])
    day = daily.where(F.col("date") == F.lit(ONE_DAY).cast("date"))
    KEYS.store_ranked(day.where(F.col("city") != day.agg(F.min("city")).first()[0]), path, ["city"])
    return KEYS.read_dense(spark, path)


def _fact_range_stored(spark, d):
    """J2-J5, J7 over daily tables that are stored bucketed by (city, date)."""
    database = f"weather_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_scratch(spark, 'bucketed')}'")
    tables = W.daily_tables(spark, d)
    names = ("daily_temperature", "daily_pressure", "humidity_daily_average", "wind_speed_daily_average")
    for name in names:
        SK.write_bucketed(tables[name], SK.table_name(database, name), 8, ["city", "date"], ["city", "date"])
    stored = [spark.table(SK.table_name(database, name)) for name in names]
    return J.join_fact_range(S.cities(spark, d), *stored, S.STANDIN_COUNTRIES)


def _dense_ids(spark, d):
    return KEYS.with_dense_id(D.daily_temperature(S.event_readings(spark, d, "temperature")), ["date", "city"])


def _daily_series(spark, d):
    """Daily mean temperature per city, days numbered from 1970-01-01; days
    without a fact row are gaps."""
    return _fact_r(spark, d).select("city", F.unix_date("date").cast("long").alias("day"), F.col("temperature").alias("value"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = {} if LLM is None else {**LLM.queries(), "pipeline": PIPELINE.run}
    return {**_weather_queries(), **more}


def _weather_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ev = lambda a: (lambda spark, d: S.event_readings(spark, d, a))
    return {
        # scalar functions P1-P4, P6-P9, P11 over every event
        "scalar_functions": _scalar_functions,
        # A1-A4, W3 on events as one long reading table
        "daily_humidity_events": lambda s, d: D.daily_humidity(ev("humidity")(s, d)),
        "daily_wind_speed_events": lambda s, d: D.daily_wind_speed(ev("wind_speed")(s, d)),
        "daily_temperature_events": lambda s, d: D.daily_temperature(ev("temperature")(s, d)),
        "daily_pressure_events": lambda s, d: D.daily_pressure(ev("pressure")(s, d)),
        "daily_direction_events": lambda s, d: D.daily_direction(S.event_degrees(s, d)),
        "daily_direction_events_window": lambda s, d: D.daily_direction(S.event_degrees(s, d), method="window"),
        "first_direction_per_reading": lambda s, d: D.with_first_direction(S.event_degrees(s, d)),
        # I4 / F1: one day only
        "daily_temperature_one_day": lambda s, d: D.daily_temperature(ev("temperature")(s, d), day=ONE_DAY),
        # Staged, aggregated and written by the incremental job
        "staged_daily_temperature": lambda s, d: _staged_daily(s, d, "temperature"),
        "staged_daily_direction": lambda s, d: _staged_daily(s, d, "wind_direction"),
        # A1-A4, W3 on the order / line stand-ins
        "daily_temperature": lambda s, d: W.daily_tables(s, d)["daily_temperature"],
        "daily_pressure": lambda s, d: W.daily_tables(s, d)["daily_pressure"],
        "humidity_daily_average": lambda s, d: W.daily_tables(s, d)["humidity_daily_average"],
        "wind_speed_daily_average": lambda s, d: W.daily_tables(s, d)["wind_speed_daily_average"],
        "wind_direction_daily_average": lambda s, d: W.daily_tables(s, d)["wind_direction_daily_average"],
        # J1-J7
        "fact_direction_join": lambda s, d: _fact_d(s, d, "join"),
        "fact_direction": lambda s, d: _fact_d(s, d),
        "fact_direction_stacked": lambda s, d: _fact_d(s, d, "stacked"),
        "fact_range_join": lambda s, d: _fact_r(s, d, "join"),
        "fact_range": lambda s, d: _fact_r(s, d),
        "fact_range_stacked": lambda s, d: _fact_r(s, d, "stacked"),
        # Q1-Q8
        "average_value": lambda s, d: V.average_value(_fact_d(s, d), "Temperature", MONTH, COUNTRY),
        "range_value": lambda s, d: V.range_value(_fact_d(s, d), "Pressure", MONTH, COUNTRY),
        "top_cities": _q3_top,
        "top_cities_filtered": lambda s, d: V.top_cities(_fact_d(s, d), "Wind Speed", 3, "top", MONTH, COUNTRY, "filtered"),
        "top_cities_global_n3": lambda s, d: V.top_cities(_fact_d(s, d), "Temperature", 3, "top", MONTH, COUNTRY, "global"),
        "top_cities_all": lambda s, d: V.top_cities(
            W.fact_direction(s, d, countries=None), "Temperature", 10, "top", None, None, "global"
        ),
        "bottom_cities_n3": lambda s, d: V.top_cities(_fact_d(s, d), "Temperature", 3, "bottom", None, COUNTRY, "global"),
        "consistent_cities_n3": lambda s, d: V.consistent_cities(_fact_d(s, d), "Temperature", 3, None, None),
        "bottom_cities": lambda s, d: V.top_cities(_fact_d(s, d), "Temperature", 10, "bottom", MONTH, COUNTRY, "global"),
        "consistent_cities": lambda s, d: V.consistent_cities(_fact_d(s, d), "Temperature", 10, MONTH, COUNTRY),
        "consistent_cities_by_range": lambda s, d: V.consistent_cities(
            _fact_d(s, d), "Humidity", 3, MONTH, COUNTRY, "filtered", "range"
        ),
        "map_data": lambda s, d: V.map_data(_fact_d(s, d), "Humidity", MONTH, COUNTRY),
        "climate_series_year": lambda s, d: V.climate_series(_fact_r(s, d), "temperature", "year"),
        "climate_series_season": lambda s, d: V.climate_series(
            _fact_r(s, d), "wind speed", "quarter", [FORECAST_CITY, "NATION_3"], None
        ),
        "climate_series_month": lambda s, d: V.climate_series(_fact_r(s, d), "pressure", "month", None, [1, 2, 12]),
        "climate_series_day_subset": lambda s, d: V.climate_series(
            _fact_r(s, d), "humidity", "day", None, None, ["average", "maximum"]
        ),
        # F10 with the chosen buckets as a DataFrame: the years of the hottest readings
        "climate_map_cross_filter": lambda s, d: V.climate_map(
            _fact_r(s, d), "temperature", "year", None,
            _fact_r(s, d).where("max_temperature >= 160000").select(F.year("date").cast("string").alias("bucket")).distinct(),
        ),
        "climate_map": lambda s, d: V.climate_map(_fact_r(s, d), "temperature", "year", None, CHOSEN_YEARS),
        # A10-A12
        "yearly_average": lambda s, d: V.yearly_series(_fact_r(s, d), "temperature", [FORECAST_CITY], YEARS),
        "drill_country_city": lambda s, d: A.drill_country_city(_fact_d(s, d), "temperature"),
        "plain_aggregates_by_year": lambda s, d: A.plain_aggregates(
            _fact_r(s, d), "temperature", (F.year("date").cast("long").alias("year"),)
        ),
        # R1 + R2, K1, S10
        "wide_to_long": _wide_roundtrip,
        "csv_roundtrip": _csv_roundtrip,
        "quarantined_lines": _quarantined_lines,
        # I1-I6, ST1/ST2, S2, S9
        "run_days_daily": _run_days_daily,
        "run_attributes_daily": _run_attributes_daily,
        "catalog_days_daily": _catalog_days_daily,
        "stream_days_daily": _stream_days_daily,
        "ledger_days": _ledger_days,
        "city_file": _city_file,
        "city_rows": _city_rows,
        "snapshot_series": _snapshot_series,
        "dense_ids": _dense_ids,
        "dense_ids_rerun": _dense_ids_rerun,
        "fact_range_stored": _fact_range_stored,
        "fact_profile": _profile,
        "fact_profile_sketches": _profile_sketches,
        # FC4-FC6 and FC1-FC3
        "trend_lines": lambda s, d: V.temperature_trend(_fact_r(s, d), "temperature", None, ALL_YEARS),
        "forecast_monthly": lambda s, d: V.monthly_forecast(_fact_r(s, d), "temperature", None, ALL_YEARS, 12),
        "forecast_trend": lambda s, d: V.forecast_trend(_fact_r(s, d), "temperature", None, YEARS, 3),
        "forecast_ignore_last": lambda s, d: V.temperature_forecast(_fact_r(s, d), "temperature", None, ALL_YEARS, 3, 1),
        "filled_daily_zero": lambda s, d: FC.fill_missing(_daily_series(s, d), ["city"], "day", "value", "zero"),
        "filled_daily_series": lambda s, d: FC.fill_missing(_daily_series(s, d), ["city"], "day", "value", "interpolate"),
        "forecast": lambda s, d: V.temperature_forecast(_fact_r(s, d), "temperature", [FORECAST_CITY], YEARS, 3),
        "forecast_all_cities": lambda s, d: V.temperature_forecast(_fact_r(s, d), "temperature", None, YEARS, 3),
    }


# ----------------------------------------------------------------------------
# DuckDB side
# ----------------------------------------------------------------------------

def _daily_events_sql(measure: str, value_expr: str) -> str:
    return f"""
SELECT CAST(ts AS DATE) AS date, event_type AS city,
       {mean(value_expr)} AS {measure},
       {rnd('min(' + value_expr + ')')} AS min_{measure},
       {rnd('max(' + value_expr + ')')} AS max_{measure}
FROM events {{where}} GROUP BY CAST(ts AS DATE), event_type"""


_MONTH_FILTER = "date >= DATE '1997-08-01' AND date < DATE '1997-09-01'"


def _top_sql(fact: str, col: str, n: int, order: str, value: str, scope: str, value_order: str) -> tuple[str, list[str]]:
    """(final SELECT, [ranked CTE]) for a top/bottom view over ``fact``."""
    rank_src = f"SELECT * FROM {fact}" if scope == "global" else f"SELECT * FROM {fact} WHERE {_MONTH_FILTER} AND country = 'AMERICA'"
    rank_metric = f"avg({col})" if order.startswith("avg") else f"max({col}) - min({col})"
    direction = "DESC" if order.endswith("desc") else "ASC"
    cte = f"""ranked AS (
  SELECT city FROM ({rank_src}) r GROUP BY city HAVING {rank_metric} IS NOT NULL
  ORDER BY {rank_metric} {direction}, city ASC LIMIT {n})"""
    sel = f"""
SELECT city, {value} AS value FROM {fact}
WHERE city IN (SELECT city FROM ranked) AND {_MONTH_FILTER} AND country = 'AMERICA'
GROUP BY city ORDER BY value {value_order}, city"""
    return sel, [cte]


def _series_sql(col: str, low: str, high: str, bucket: str, order: str, where: str) -> str:
    base = f"""per AS (
  SELECT {bucket} AS bucket, CAST({order} AS BIGINT) AS bucket_order,
         max({high}) AS maximum, min({low}) AS minimum, avg({col}) AS average
  FROM fact_range {where} GROUP BY 1, 2)"""
    sel = """
SELECT bucket, bucket_order, 'maximum' AS measure_name, CAST(maximum AS DOUBLE) AS value, CAST(1 AS BIGINT) AS measure_order FROM per
UNION ALL SELECT bucket, bucket_order, 'minimum', CAST(minimum AS DOUBLE), CAST(2 AS BIGINT) FROM per
UNION ALL SELECT bucket, bucket_order, 'average', CAST(average AS DOUBLE), CAST(3 AS BIGINT) FROM per"""
    return with_ctes(["fact_range"], sel, [base])


def _series_subset_sql() -> str:
    base = """per AS (
  SELECT CAST(day(date) AS VARCHAR) AS bucket, CAST(day(date) AS BIGINT) AS bucket_order,
         max(max_humidity) AS maximum, avg(humidity) AS average
  FROM fact_range GROUP BY 1, 2)"""
    sel = """
SELECT bucket, bucket_order, 'maximum' AS measure_name, CAST(maximum AS DOUBLE) AS value, CAST(1 AS BIGINT) AS measure_order FROM per
UNION ALL SELECT bucket, bucket_order, 'average', CAST(average AS DOUBLE), CAST(3 AS BIGINT) FROM per"""
    return with_ctes(["fact_range"], sel, [base])


_SEASON_SQL = (
    "CASE WHEN month(date) BETWEEN 9 AND 11 THEN 'Fall' WHEN month(date) BETWEEN 3 AND 5 THEN 'Spring' "
    "WHEN month(date) BETWEEN 6 AND 8 THEN 'Summer' ELSE 'Winter' END"
)
_SEASON_ORDER_SQL = (
    "CASE WHEN month(date) BETWEEN 9 AND 11 THEN 0 WHEN month(date) BETWEEN 3 AND 5 THEN 1 "
    "WHEN month(date) BETWEEN 6 AND 8 THEN 2 ELSE 3 END"
)


def _num_text(c: str) -> str:
    return f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


_PROFILE_TYPES = {
    "date": "date",
    "country": "string",
    "city": "string",
    "latitude": "double",
    "longitude": "double",
    "temperature": "double",
    "pressure": "double",
    "humidity": "double",
    "wind_speed": "double",
    "wind_direction": "string",
}


def _profile_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(DISTINCT {c}) AS distinct_count,
       count(*) - count({c}) AS null_count, count(*) AS row_count FROM fact_direction"""
        for c, t in _PROFILE_TYPES.items()
    ]
    return "\nUNION ALL ".join(parts)


_FILLED_CTES = [
    """s AS (SELECT city, CAST(date - DATE '1970-01-01' AS BIGINT) AS day, temperature AS value FROM fact_range)""",
    """b AS (SELECT city, min(day) AS lo, max(day) AS hi FROM s GROUP BY city)""",
    """g AS (SELECT city, unnest(range(lo, hi + 1)) AS day FROM b)""",
    """f AS (SELECT g.city, g.day, s.value AS y FROM g LEFT JOIN s ON g.city = s.city AND g.day = s.day)""",
    """w AS (SELECT city, day, y,
  last_value(CASE WHEN y IS NOT NULL THEN day END IGNORE NULLS) OVER (PARTITION BY city ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t0,
  last_value(y IGNORE NULLS) OVER (PARTITION BY city ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y0,
  first_value(CASE WHEN y IS NOT NULL THEN day END IGNORE NULLS) OVER (PARTITION BY city ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t1,
  first_value(y IGNORE NULLS) OVER (PARTITION BY city ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS y1
  FROM f)""",
]
_FILLED_SQL = """
SELECT city, day, coalesce(y, y0 + (y1 - y0) * (day - t0) / (t1 - t0)) AS value, y IS NULL AS filled FROM w"""


# events with the same type and second share a cell of the wide files: their mean
_RUN_DAYS_SQL = """
SELECT CAST(s AS DATE) AS date, city, {mean} AS {measure}, round(min({value}), 0) AS min_{measure}, round(max({value}), 0) AS max_{measure}
FROM (SELECT date_trunc('second', ts) AS s, event_type AS city, round(avg(value), 9) AS v FROM events GROUP BY 1, 2) t
GROUP BY 1, 2"""


def _forecast_ctes() -> list[str]:
    """The smoothing fold as a recursive CTE over (city, candidate, step)."""
    n_alpha, n_beta = len(FC.ALPHAS), len(FC.BETAS)
    return [
        """spans AS (SELECT city, year AS t0, value AS y0,
  lead(year) OVER (PARTITION BY city ORDER BY year) AS t1, lead(value) OVER (PARTITION BY city ORDER BY year) AS y1
  FROM yearly WHERE value IS NOT NULL)""",
        """filled AS (SELECT city, tt AS year,
  CASE WHEN tt = t0 THEN y0 ELSE y0 + (y1 - y0) * (tt - t0) / (t1 - t0) END AS value
  FROM (SELECT *, unnest(range(t0, coalesce(t1 - 1, t0) + 1)) AS tt FROM spans))""",
        """pts AS (SELECT city, year AS t, value AS y,
  row_number() OVER (PARTITION BY city ORDER BY year) AS i, count(*) OVER (PARTITION BY city) AS n FROM filled)""",
        """keys AS (SELECT DISTINCT city, n FROM pts)""",
        f"""cand AS (
  SELECT city, n, 'simple' AS model, CAST(ai * 0.05 AS DOUBLE) AS alpha, CAST(0 AS DOUBLE) AS beta, 2 AS k
  FROM (SELECT city, n, unnest(range(1, {n_alpha + 1})) AS ai FROM keys)
  UNION ALL
  SELECT city, n, 'holt', CAST(ai * 0.05 AS DOUBLE), CAST(0.05 + bj * 0.1 AS DOUBLE), 4
  FROM (SELECT city, n, ai, unnest(range(0, {n_beta})) AS bj
        FROM (SELECT city, n, unnest(range(1, {n_alpha + 1})) AS ai FROM keys))
  WHERE 4 < n)""",
        """fold AS (
  SELECT c.city, c.model, c.alpha, c.beta, c.k, c.n, CAST(1 AS BIGINT) AS i, CAST(p1.y AS DOUBLE) AS l,
         CAST(CASE WHEN c.model = 'holt' THEN coalesce(p2.y, p1.y) - p1.y ELSE 0 END AS DOUBLE) AS b,
         CAST(0 AS DOUBLE) AS sse
  FROM cand c JOIN pts p1 ON p1.city = c.city AND p1.i = 1
  LEFT JOIN pts p2 ON p2.city = c.city AND p2.i = 2
  UNION ALL
  SELECT f.city, f.model, f.alpha, f.beta, f.k, f.n, f.i + 1,
         (f.l + f.b) + f.alpha * (p.y - (f.l + f.b)),
         f.b + f.alpha * f.beta * (p.y - (f.l + f.b)),
         f.sse + (p.y - (f.l + f.b)) * (p.y - (f.l + f.b))
  FROM fold f JOIN pts p ON p.city = f.city AND p.i = f.i + 1)""",
        """scored AS (
  SELECT city, model, alpha, beta, k, n, l, b, sse / n AS sigma2,
         round(n * ln(greatest(sse / n, 1e-12)) + 2 * k, 9) AS aic
  FROM fold WHERE i = n)""",
        """best AS (
  SELECT city, arg_min(model, (aic, k, alpha, beta)) AS model, arg_min(alpha, (aic, k, alpha, beta)) AS alpha,
         arg_min(beta, (aic, k, alpha, beta)) AS beta, arg_min(l, (aic, k, alpha, beta)) AS l,
         arg_min(b, (aic, k, alpha, beta)) AS b, arg_min(sigma2, (aic, k, alpha, beta)) AS sigma2
  FROM scored GROUP BY city)""",
        f"""est AS (
  SELECT city, (SELECT max(t) FROM pts WHERE pts.city = best.city) + h AS year,
         l + h * b AS e,
         {FC.Z95!r} * sqrt(CASE WHEN model = 'holt'
             THEN sigma2 * (1.0 + (h - 1) * alpha * alpha * (1 + beta * h + beta * beta * h * (2 * h - 1) / 6))
             ELSE sigma2 * (1.0 + (h - 1) * alpha * alpha) END) AS half
  FROM (SELECT *, unnest(range(1, 4)) AS h FROM best) best)""",
    ]


def _monthly_ctes() -> list[str]:
    """Holt-Winters in its component form, the season a list whose head is the
    month to come, as a recursive CTE over (city, candidate, month)."""
    few = ", ".join(str(g) for g in FC.GAMMAS)
    return [
        f"""monthly AS (SELECT city, year(date) * 12 + month(date) - 1 AS p, avg(temperature) AS value FROM fact_range
  WHERE year(date) BETWEEN {ALL_YEARS[0]} AND {ALL_YEARS[1]} GROUP BY 1, 2)""",
        """spans AS (SELECT city, p AS t0, value AS y0, lead(p) OVER w AS t1, lead(value) OVER w AS y1
  FROM monthly WINDOW w AS (PARTITION BY city ORDER BY p))""",
        """pts AS (SELECT city, tt AS t, CASE WHEN tt = t0 THEN y0 ELSE y0 + (y1 - y0) * (tt - t0) / (t1 - t0) END AS y,
    row_number() OVER (PARTITION BY city ORDER BY tt) AS i, count(*) OVER (PARTITION BY city) AS n
  FROM (SELECT *, unnest(range(t0, coalesce(t1 - 1, t0) + 1)) AS tt FROM spans))""",
        """cycles AS (SELECT city, any_value(n) AS n, max(t) AS last, list(y ORDER BY i) FILTER (i <= 12) AS first,
    avg(y) FILTER (i <= 12) AS mean1, avg(y) FILTER (i > 12 AND i <= 24) AS mean2 FROM pts GROUP BY city)""",
        f"""cand AS (
  SELECT 'simple' AS model, round(a * 0.05, 2) AS alpha, 0.0 AS beta, 0.0 AS gamma, 2 AS k FROM range(1, 20) r(a)
  UNION ALL SELECT 'holt', round(a * 0.05, 2), round(0.05 + b * 0.1, 2), 0.0, 4 FROM range(1, 20) r(a), range(10) q(b)
  UNION ALL SELECT 'seasonal', round(a * 0.05, 2), 0.0, g, 14 FROM range(1, 20) r(a), unnest([{few}]) q(g)
  UNION ALL SELECT 'holt_winters', a, b, g, 16 FROM unnest([{few}]) r(a), unnest([{few}]) s(b), unnest([{few}]) q(g))""",
        """begun AS (
  SELECT c.city, model, CAST(alpha AS DOUBLE) AS alpha, CAST(beta AS DOUBLE) AS beta, CAST(gamma AS DOUBLE) AS gamma, k, n, last, first,
         model IN ('seasonal', 'holt_winters') AS cyc, CASE model WHEN 'holt_winters' THEN (mean2 - mean1) / 12 ELSE 0 END AS slope, mean1
  FROM cycles c, cand WHERE (k < n OR model = 'simple') AND (model NOT IN ('seasonal', 'holt_winters') OR n >= 36))""",
        """fold AS (
  SELECT city, model, alpha, beta, gamma, k, n, last, CAST(CASE WHEN cyc THEN 0 ELSE 1 END AS BIGINT) AS i,
         CAST(CASE WHEN cyc THEN mean1 - slope * 13 / 2 ELSE first[1] END AS DOUBLE) AS l,
         CAST(CASE WHEN cyc THEN slope WHEN model = 'holt' THEN coalesce(first[2], first[1]) - first[1] ELSE 0 END AS DOUBLE) AS b,
         CASE WHEN cyc THEN [first[j] - (mean1 - slope * 13 / 2 + slope * j) FOR j IN range(1, 13)] ELSE [CAST(0 AS DOUBLE)] END AS s,
         CAST(0 AS DOUBLE) AS sse FROM begun
  UNION ALL
  SELECT f.city, model, alpha, beta, gamma, k, f.n, last, f.i + 1,
         alpha * (p.y - s[1]) + (1 - alpha) * (l + b),
         beta * (alpha * (p.y - s[1]) + (1 - alpha) * (l + b) - l) + (1 - beta) * b,
         s[2:] || [gamma * (p.y - l - b) + (1 - gamma) * s[1]],
         sse + (p.y - l - b - s[1]) * (p.y - l - b - s[1])
  FROM fold f JOIN pts p ON p.city = f.city AND p.i = f.i + 1)""",
        """best AS (
  SELECT * FROM fold WHERE i = n
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY round(n * ln(greatest(sse / n, 1e-12)) + 2 * k, 9), k, alpha, beta, gamma) = 1)""",
        f"""est AS (
  SELECT city, last + h AS p, l + h * b + s[(h - 1) % len(s) + 1] AS e,
         {FC.Z95!r} * sqrt(sse / n * (1 + coalesce(list_sum([pow(alpha * (1 + beta * j) + CASE WHEN j % len(s) = 0 THEN gamma ELSE 0 END, 2)
           FOR j IN range(1, h)]), 0))) AS half
  FROM (SELECT *, unnest(range(1, 13)) AS h FROM best))""",
    ]


_MONTHLY_SQL = """
SELECT *, format('{:,.1f}', value) AS value_text FROM (
SELECT city, make_date(CAST(p // 12 AS INT), CAST(p % 12 + 1 AS INT), 1) AS month, value, CAST(NULL AS DOUBLE) AS lower,
       CAST(NULL AS DOUBLE) AS upper, 'Actual' AS indicator, CAST(1 AS BIGINT) AS indicator_order FROM monthly
UNION ALL
SELECT city, make_date(CAST(p // 12 AS INT), CAST(p % 12 + 1 AS INT), 1), round(e, 6), round(e - half, 6), round(e + half, 6),
       'Estimate', CAST(2 AS BIGINT) FROM est)"""


def _forecast_ignoring_ctes() -> list[str]:
    """As above, the last year of each city left out of the fit."""
    return ["spans_of AS (SELECT city, year, value FROM yearly y WHERE year < (SELECT max(year) FROM yearly z WHERE z.city = y.city))"] + [
        c.replace("FROM yearly", "FROM spans_of") if c.startswith("spans AS") else c for c in _forecast_ctes()
    ]


def _forecast_trend_sql() -> str:
    return f"""
SELECT city, indicator, count(*) AS n, round(regr_slope(value, year), 6) AS slope,
       round(regr_intercept(value, year), 2) AS intercept, round(regr_r2(value, year), 6) AS r2
FROM ({_forecast_sql()}) r GROUP BY city, indicator"""


def _forecast_sql() -> str:
    return """
SELECT *, format('{:,.1f}', value) AS value_text FROM (
SELECT city, year, value, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper,
       'Actual' AS indicator, CAST(1 AS BIGINT) AS indicator_order FROM yearly
UNION ALL
SELECT city, year, round(e, 6), round(e - half, 6), round(e + half, 6), 'Estimate', CAST(2 AS BIGINT) FROM est)"""


def oracle_sql() -> dict[str, str]:
    more = {} if LLM is None else dict(LLM.oracle_sql())
    if PIPELINE is not None and PIPELINE.ORACLE_SQL is not None:
        more["pipeline"] = PIPELINE.ORACLE_SQL
    return {**_weather_oracles(), **more}


def _weather_oracles() -> dict[str, str]:
    deg = "((value * 37) % 360)"
    ev_dir = f"""
SELECT CAST(ts AS DATE) AS date, event_type AS city,
       arg_min({compass_sql(deg)}, ts) AS wind_direction
FROM events GROUP BY CAST(ts AS DATE), event_type"""
    fd = lambda sel, extra=None: with_ctes(["fact_direction"], sel, extra)
    fr = lambda sel, extra=None, rec=False: with_ctes(["fact_range"], sel, extra, rec)
    yearly = lambda cities, y0, y1: f"""yearly AS (
  SELECT city, CAST(year(date) AS BIGINT) AS year, avg(temperature) AS value FROM fact_range
  WHERE {cities} date >= DATE '{y0}-01-01' AND date < DATE '{y1 + 1}-01-01'
  GROUP BY city, year(date))"""
    return {
        "scalar_functions": f"""
SELECT event_id, CAST(ts AS DATE) AS date,
       {rnd(fahrenheit('value'))} AS fahrenheit,
       round_even(value, 0) AS value_bround,
       {compass_sql(deg)} AS direction,
       CAST(year(ts) * 100 + month(ts) AS BIGINT) AS month_year,
       {_SEASON_SQL.replace('date', 'ts')} AS season,
       CAST(year(ts) AS VARCHAR) AS year_bucket,
       CAST(month(ts) AS VARCHAR) AS month_bucket,
       CAST(day(ts) AS VARCHAR) AS day_bucket,
       format('{{:,.1f}}', value * 1000) AS value_text
FROM events""",
        "daily_humidity_events": _daily_events_sql("humidity", "value").format(where=""),
        "daily_wind_speed_events": _daily_events_sql("wind_speed", "value").format(where=""),
        "daily_temperature_events": _daily_events_sql("temperature", fahrenheit("value")).format(where=""),
        "daily_pressure_events": _daily_events_sql("pressure", "value").format(where=""),
        "daily_direction_events": ev_dir,
        "daily_direction_events_window": ev_dir,
        "first_direction_per_reading": f"""
SELECT CAST(ts AS DATE) AS date, event_type AS city, ts AS datetime, {compass_sql(deg)} AS direction,
       first_value({compass_sql(deg)}) OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts) AS direction_of_wind
FROM events""",
        "staged_daily_temperature": _daily_events_sql("temperature", fahrenheit("value")).format(where=""),
        "staged_daily_direction": ev_dir,
        "daily_temperature_one_day": _daily_events_sql("temperature", fahrenheit("value")).format(
            where=f"WHERE CAST(ts AS DATE) = DATE '{ONE_DAY}'"
        ),
        "daily_temperature": with_ctes(["d_temperature"], "SELECT * FROM d_temperature"),
        "daily_pressure": with_ctes(["d_pressure"], "SELECT * FROM d_pressure"),
        "humidity_daily_average": with_ctes(["d_humidity"], "SELECT * FROM d_humidity"),
        "wind_speed_daily_average": with_ctes(["d_wind_speed"], "SELECT * FROM d_wind_speed"),
        "wind_direction_daily_average": with_ctes(["d_direction"], "SELECT * FROM d_direction"),
        "fact_direction_join": fd("SELECT * FROM fact_direction"),
        "fact_direction": fd("SELECT * FROM fact_direction"),
        "fact_direction_stacked": fd("SELECT * FROM fact_direction"),
        "fact_range_join": fr("SELECT * FROM fact_range"),
        "fact_range": fr("SELECT * FROM fact_range"),
        "fact_range_stacked": fr("SELECT * FROM fact_range"),
        "average_value": fd(f"SELECT avg(temperature) AS value FROM fact_direction WHERE {_MONTH_FILTER} AND country = 'AMERICA'"),
        "range_value": fd(
            f"SELECT max(pressure) - min(pressure) AS value FROM fact_direction WHERE {_MONTH_FILTER} AND country = 'AMERICA'"
        ),
        "top_cities": fd(*_top_sql("fact_direction", "temperature", 10, "avg desc", "avg(temperature)", "global", "DESC")),
        "top_cities_filtered": fd(
            *_top_sql("fact_direction", "wind_speed", 3, "avg desc", "avg(wind_speed)", "filtered", "DESC")
        ),
        "top_cities_global_n3": fd(
            *_top_sql("fact_direction", "temperature", 3, "avg desc", "avg(temperature)", "global", "DESC")
        ),
        "top_cities_all": with_ctes(
            ["fact_direction"], "SELECT city, avg(temperature) AS value FROM fact_direction GROUP BY city ORDER BY value DESC, city LIMIT 10"
        ).replace("WHERE c.country IN ('AMERICA', 'EUROPE')", ""),
        "bottom_cities_n3": fd(
            """SELECT r.city, r.value FROM (
  SELECT city, avg(temperature) AS rank, avg(temperature) FILTER (country = 'AMERICA') AS value, count(*) FILTER (country = 'AMERICA') AS n
  FROM fact_direction GROUP BY city ORDER BY rank, city LIMIT 3) r WHERE r.n > 0"""
        ),
        "consistent_cities_n3": fd(
            """SELECT city, value FROM (
  SELECT city, max(temperature) - min(temperature) AS value FROM fact_direction GROUP BY city ORDER BY avg(temperature), city LIMIT 3) r"""
        ),
        "bottom_cities": fd(*_top_sql("fact_direction", "temperature", 10, "avg asc", "avg(temperature)", "global", "ASC")),
        "consistent_cities": fd(
            *_top_sql("fact_direction", "temperature", 10, "avg asc", "max(temperature) - min(temperature)", "global", "ASC")
        ),
        "consistent_cities_by_range": fd(
            *_top_sql("fact_direction", "humidity", 3, "range asc", "max(humidity) - min(humidity)", "filtered", "ASC")
        ),
        "map_data": fd(
            f"""SELECT city, latitude, longitude, avg(humidity) AS value FROM fact_direction
WHERE {_MONTH_FILTER} AND country = 'AMERICA' GROUP BY city, latitude, longitude"""
        ),
        "climate_series_year": _series_sql(
            "temperature", "min_temperature", "max_temperature", "CAST(year(date) AS VARCHAR)", "year(date)", ""
        ),
        "climate_series_season": _series_sql(
            "wind_speed", "min_wind_speed", "max_wind_speed", _SEASON_SQL, _SEASON_ORDER_SQL,
            f"WHERE city IN ('{FORECAST_CITY}', 'NATION_3')",
        ),
        "climate_series_month": _series_sql(
            "pressure", "min_pressure", "max_pressure", "CAST(month(date) AS VARCHAR)", "month(date)",
            "WHERE month(date) IN (1, 2, 12)",
        ),
        "climate_series_day_subset": _series_subset_sql(),
        "climate_map": fr(
            f"""SELECT country, city, latitude, longitude, max(max_temperature) AS maximum,
       min(min_temperature) AS minimum, avg(temperature) AS average,
       printf('(%s°F  ,  %s°F)', {_num_text('min(min_temperature)')}, {_num_text('max(max_temperature)')}) AS label
FROM fact_range WHERE CAST(year(date) AS VARCHAR) IN ('1997', '1998')
GROUP BY country, city, latitude, longitude"""
        ),
        "climate_map_cross_filter": fr(
            f"""SELECT country, city, latitude, longitude, max(max_temperature) AS maximum,
       min(min_temperature) AS minimum, avg(temperature) AS average,
       printf('(%s°F  ,  %s°F)', {_num_text('min(min_temperature)')}, {_num_text('max(max_temperature)')}) AS label
FROM fact_range f WHERE NOT EXISTS (SELECT 1 FROM fact_range WHERE max_temperature >= 160000)
   OR year(f.date) IN (SELECT year(date) FROM fact_range WHERE max_temperature >= 160000)
GROUP BY country, city, latitude, longitude"""
        ),
        "yearly_average": fr("SELECT * FROM yearly", [yearly(f"city = '{FORECAST_CITY}' AND", *YEARS)]),
        "drill_country_city": fd(
            """SELECT country, city, avg(temperature) AS value, count(*) AS days,
       CAST(grouping(country, city) AS BIGINT) AS level
FROM fact_direction GROUP BY ROLLUP (country, city)"""
        ),
        "plain_aggregates_by_year": fr(
            """SELECT CAST(year(date) AS BIGINT) AS year, sum(temperature) AS sum_mean, sum(min_temperature) AS sum_min,
       sum(max_temperature) AS sum_max, avg(temperature) AS avg_mean, max(temperature) AS max_mean,
       min(temperature) AS min_mean
FROM fact_range GROUP BY year(date)"""
        ),
        "wide_to_long": """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS datetime, event_type AS city, round(avg(value), 9) AS value
FROM events GROUP BY 1, 2""",
        "csv_roundtrip": """
SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS datetime, event_type AS city, round(avg(value), 9) AS value
FROM events GROUP BY 1, 2""",
        "quarantined_lines": """
WITH cells AS (SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS datetime, event_type AS city, round(avg(value), 9) AS value
  FROM events GROUP BY 1, 2)
SELECT datetime, '' AS reason, city, value FROM cells WHERE NOT ends_with(datetime, ':07') AND NOT ends_with(datetime, ':13')
UNION ALL SELECT DISTINCT replace(datetime, '-', '/'), 'datetime', CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM cells WHERE ends_with(datetime, ':07')
UNION ALL SELECT DISTINCT datetime, 'value', CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM cells WHERE ends_with(datetime, ':13')""",
        "run_days_daily": _RUN_DAYS_SQL.format(measure="temperature", value=fahrenheit("v"), mean=mean(fahrenheit("v"))),
        "run_attributes_daily": "SELECT * FROM ("
        + _RUN_DAYS_SQL.format(measure="humidity", value="v", mean=mean("v"))
        + ") h JOIN ("
        + _RUN_DAYS_SQL.format(measure="temperature", value=fahrenheit("v"), mean=mean(fahrenheit("v")))
        + ") t USING (date, city)",
        "catalog_days_daily": "SELECT CAST(date - DATE '1970-01-01' AS BIGINT) * 4294967296 + row_number() OVER (PARTITION BY date ORDER BY city) AS id, *\nFROM ("
        + _RUN_DAYS_SQL.format(measure="temperature", value=fahrenheit("v"), mean=mean(fahrenheit("v")))
        + ") t",
        "stream_days_daily": _RUN_DAYS_SQL.format(measure="pressure", value="v", mean=mean("v")),
        "ledger_days": """
SELECT row_number() OVER (ORDER BY d) AS seq, d AS date, CAST(max(d) OVER () + 1 AS DATE) AS next_day
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) t""",
        "city_rows": with_ctes(
            ["cities"],
            """SELECT city AS "City", country AS "Country", CAST(latitude AS VARCHAR) AS "Latitude", CAST(longitude AS VARCHAR) AS "Longitude" FROM cities""",
        ),
        "city_file": with_ctes(["cities"], "SELECT * FROM cities"),
        "snapshot_series": _series_sql(
            "temperature", "min_temperature", "max_temperature", "CAST(year(date) AS VARCHAR)", "year(date)", ""
        ),
        "forecast_monthly": fr(_MONTHLY_SQL, _monthly_ctes(), True),
        "forecast_trend": fr(_forecast_trend_sql(), [yearly("", *YEARS)] + _forecast_ctes(), True),
        "forecast_ignore_last": fr(_forecast_sql(), [yearly("", *ALL_YEARS)] + _forecast_ignoring_ctes(), True),
        "filled_daily_zero": fr(_FILLED_SQL.replace("y0 + (y1 - y0) * (day - t0) / (t1 - t0)", "0"), _FILLED_CTES),
        "dense_ids": f"""
SELECT row_number() OVER (ORDER BY date, city) AS id, * FROM (
{_daily_events_sql('temperature', fahrenheit('value')).format(where='')}) t""",
        "dense_ids_rerun": f"""
SELECT row_number() OVER (ORDER BY date, city) AS id, * FROM (
{_daily_events_sql('temperature', fahrenheit('value')).format(where='')}) t
WHERE NOT (date = DATE '{ONE_DAY}' AND city = (SELECT min(event_type) FROM events WHERE CAST(ts AS DATE) = DATE '{ONE_DAY}'))""",
        "fact_range_stored": fr("SELECT * FROM fact_range"),
        "fact_profile": fd(_profile_sql()),
        "fact_profile_sketches": fd(f"""
SELECT column_name, data_type, CAST(round(distinct_count / u) * u AS BIGINT) AS distinct_about, null_count, row_count
FROM (SELECT *, pow(10, greatest(length(CAST(distinct_count AS VARCHAR)) - 2, 0)) AS u FROM ({_profile_sql()}) p) q"""),
        "filled_daily_series": fr(_FILLED_SQL, _FILLED_CTES),
        "forecast": fr(_forecast_sql(), [yearly(f"city = '{FORECAST_CITY}' AND", *YEARS)] + _forecast_ctes(), True),
        "forecast_all_cities": fr(_forecast_sql(), [yearly("", *YEARS)] + _forecast_ctes(), True),
        "trend_lines": fr(
            """SELECT city, count(*) AS n, round(regr_slope(value, year), 6) AS slope,
       round(regr_intercept(value, year), 2) AS intercept, round(regr_r2(value, year), 6) AS r2
FROM yearly GROUP BY city""",
            [yearly("", *ALL_YEARS)],
        ),
    }
