"""The dashboard views Q1-Q9 as lazy DataFrame functions over a daily fact.

Defaults are the dashboards' own (month 201408, United States, top 10,
Minneapolis, 2013-2017). The measure parameter is resolved in Python, so each
plan reads only the chosen measure's columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratocast import schemas as K
from stratocast.functions.scalar import bucket_order, date_bucket, map_label
from stratocast.operators import filters as FL
from stratocast.operators import forecast as FC
from stratocast.operators import measures as A
from stratocast.operators.reshape import measure_names
from stratocast.operators.topn import manual_order, top_members


def _month_country(month_year: int | None, country) -> Column:
    return FL.month_year_matches(month_year) & FL.member_matches("country", country)


# Q1 ---------------------------------------------------------------------------
def average_value(fact: DataFrame, parameter: str = "Temperature", month_year=K.DEFAULT_MONTH_YEAR, country=K.DEFAULT_COUNTRY) -> DataFrame:
    """One number: average of the chosen daily mean in one month and country."""
    m = K.measure(parameter)
    df = fact.select("date", "country", m.mean).where(_month_country(month_year, country))
    return A.overall(df, A.average_of(m).alias("value"))


# Q2 ---------------------------------------------------------------------------
def range_value(fact: DataFrame, parameter: str = "Temperature", month_year=K.DEFAULT_MONTH_YEAR, country=K.DEFAULT_COUNTRY) -> DataFrame:
    """One number: max - min of the chosen daily mean."""
    m = K.measure(parameter)
    df = fact.select("date", "country", m.mean).where(_month_country(month_year, country))
    return A.overall(df, A.range_of(m).alias("value"))


# Q3 / Q4 / Q5 -----------------------------------------------------------------
def top_cities(
    fact: DataFrame,
    parameter: str = "Temperature",
    n: int = K.TOP_N,
    end: str = "top",
    month_year=K.DEFAULT_MONTH_YEAR,
    country=K.DEFAULT_COUNTRY,
    scope: str = "global",
) -> DataFrame:
    """Q3 (end="top") and Q4 (end="bottom"): ``(city, value)`` by average."""
    m = K.measure(parameter)
    df = fact.select("date", "country", "city", m.mean)
    return top_members(df, m, n, end, "average", "average", scope, _month_country(month_year, country))


def consistent_cities(
    fact: DataFrame,
    parameter: str = "Temperature",
    n: int = K.TOP_N,
    month_year=K.DEFAULT_MONTH_YEAR,
    country=K.DEFAULT_COUNTRY,
    scope: str = "global",
    rank_by: str = "average",
) -> DataFrame:
    """Q5: the bottom n cities (ranked by ``rank_by``; the dashboard ranks by
    average) showing their range, smallest range first."""
    m = K.measure(parameter)
    df = fact.select("date", "country", "city", m.mean)
    return top_members(df, m, n, "bottom", "range", rank_by, scope, _month_country(month_year, country))


# Q6 ---------------------------------------------------------------------------
def map_data(fact: DataFrame, parameter: str = "Temperature", month_year=K.DEFAULT_MONTH_YEAR, country=K.DEFAULT_COUNTRY) -> DataFrame:
    """Average of the chosen measure per city with its coordinates."""
    m = K.measure(parameter)
    df = fact.select("date", "country", "city", "latitude", "longitude", m.mean).where(_month_country(month_year, country))
    return df.groupBy("city", "latitude", "longitude").agg(A.average_of(m).alias("value"))


# Q7 ---------------------------------------------------------------------------
def climate_series(
    fact: DataFrame,
    parameter: str = "temperature",
    level: str = "year",
    city_list: Sequence[str] | None = None,
    month_list: Sequence[int] | None = None,
    measure_list: Sequence[str] | None = None,
) -> DataFrame:
    """Maximum, minimum and average of a measure per date bucket, one row per
    (bucket, measure name), in the manual measure order. ``measure_list``
    (F9) keeps a subset of the three measure names; only those are
    aggregated."""
    m = K.measure(parameter)
    chosen = list(K.SERIES_MEASURE_ORDER) if measure_list is None else [
        n for n in K.SERIES_MEASURE_ORDER if n in set(measure_list)
    ]
    if not chosen:
        raise ValueError("measure_list selects no measure")
    aggs = {"maximum": A.maximum_of(m), "minimum": A.minimum_of(m), "average": A.average_of(m)}
    df = fact.select("date", "city", m.mean, m.low, m.high)
    df = FL.cities(df, city_list)
    df = FL.months(df, month_list)
    per = df.groupBy(
        date_bucket("date", level).alias("bucket"), bucket_order("date", level).cast("long").alias("bucket_order")
    ).agg(*[aggs[n].alias(n) for n in chosen])
    long = measure_names(per, ["bucket", "bucket_order"], chosen)
    return long.withColumn("measure_order", manual_order("measure_name", K.SERIES_MEASURE_ORDER).cast("long"))


# Q8 ---------------------------------------------------------------------------
def climate_map(
    fact: DataFrame,
    parameter: str = "temperature",
    level: str = "year",
    city_list: Sequence[str] | None = None,
    chosen_buckets=None,
) -> DataFrame:
    """Per city: maximum, minimum, average and the map label, restricted to
    the date buckets chosen in the series view (None = all)."""
    m = K.measure(parameter)
    df = fact.select("date", "country", "city", "latitude", "longitude", m.mean, m.low, m.high)
    df = FL.cities(df, city_list)
    df = FL.selected_buckets(df, level, chosen_buckets)
    per = df.groupBy("country", "city", "latitude", "longitude").agg(
        A.maximum_of(m).alias("maximum"),
        A.minimum_of(m).alias("minimum"),
        A.average_of(m).alias("average"),
    )
    return per.withColumn("label", map_label("minimum", "maximum"))


# Q9 (series part; the forecast itself is in operators.forecast) ---------------
def yearly_series(
    fact: DataFrame,
    parameter: str = "temperature",
    city_list: Sequence[str] | None = (K.DEFAULT_FORECAST_CITY,),
    years: tuple[int, int] = K.DEFAULT_YEAR_RANGE,
) -> DataFrame:
    """``(city, year, value)``: yearly average of the chosen measure."""
    m = K.measure(parameter)
    df = FL.cities(fact.select("date", "city", m.mean), city_list)
    df = FL.year_range(df, years[0], years[1])
    return A.yearly_average(df, m, keys=("city",))


def temperature_forecast(
    fact: DataFrame,
    parameter: str = "temperature",
    city_list: Sequence[str] | None = (K.DEFAULT_FORECAST_CITY,),
    years: tuple[int, int] = K.DEFAULT_YEAR_RANGE,
    horizon: int = 3,
    ignore_last: int = 0,
) -> DataFrame:
    """Q9: yearly averages (Actual) followed by exponential-smoothing
    estimates with a 95 % band (Estimate), per city."""
    series = yearly_series(fact, parameter, city_list, years)
    return FC.forecast_with_actuals(series, ["city"], "year", "value", horizon, ignore_last, season=FC.SEASONS["year"])


def monthly_forecast(
    fact: DataFrame,
    parameter: str = "temperature",
    city_list: Sequence[str] | None = (K.DEFAULT_FORECAST_CITY,),
    years: tuple[int, int] = K.DEFAULT_YEAR_RANGE,
    horizon: int = 12,
    ignore_last: int = 0,
) -> DataFrame:
    """Q9 by month: monthly averages, then estimates of the best model with or
    without a season of twelve months. ``month`` is the month's first day."""
    m = K.measure(parameter)
    df = FL.year_range(FL.cities(fact.select("date", "city", m.mean), city_list), years[0], years[1])
    period = (F.year("date") * 12 + F.month("date") - 1).cast("long")
    series = df.groupBy("city", period.alias("period")).agg(A.average_of(m).alias("value"))
    rows = FC.forecast_with_actuals(series, ["city"], "period", "value", horizon, ignore_last, season=FC.SEASONS["month"])
    month = F.make_date(F.floor(F.col("period") / 12).cast("int"), (F.col("period") % 12 + 1).cast("int"), F.lit(1))
    return rows.select("city", month.alias("month"), *[c for c in rows.columns if c not in ("city", "period")])


def temperature_trend(
    fact: DataFrame,
    parameter: str = "temperature",
    city_list: Sequence[str] | None = (K.DEFAULT_FORECAST_CITY,),
    years: tuple[int, int] = K.DEFAULT_YEAR_RANGE,
) -> DataFrame:
    """Q9's trend line (FC6) per city over the yearly averages."""
    return FC.trend_lines(yearly_series(fact, parameter, city_list, years), ["city"], "year", "value")


def forecast_trend(
    fact: DataFrame,
    parameter: str = "temperature",
    city_list: Sequence[str] | None = (K.DEFAULT_FORECAST_CITY,),
    years: tuple[int, int] = K.DEFAULT_YEAR_RANGE,
    horizon: int = 3,
) -> DataFrame:
    """Q9's trend lines, one per colour: over the actual and over the
    estimated values of each city."""
    rows = temperature_forecast(fact, parameter, city_list, years, horizon)
    return FC.trend_lines(rows, ["city", "indicator"], "year", "value")
