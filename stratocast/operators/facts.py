"""Daily facts.

Two plans with the same result:

* ``join_fact_*``: the literal inner equi-joins of the daily tables on
  ``(city, date)`` with the city dimension on ``city`` (J1-J5). Use it when
  the daily tables are stored; bucketing them by ``city`` (see
  ``sources.sinks.write_bucketed``) removes the shuffles.
* ``fact_from_readings``: when the daily tables are computed in the same job,
  every measure is aggregated in one ``groupBy(date, city)`` over the union of
  the reading tables, and a row is kept only where every measure has
  readings, which is exactly what the inner joins keep. One scan, one
  shuffle, no join except the bounded city dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratocast.operators.daily import daily_many, first_direction_agg, merge_partials, reading

FACT_DIRECTION_COLUMNS = (
    "date",
    "country",
    "city",
    "latitude",
    "longitude",
    "temperature",
    "pressure",
    "humidity",
    "wind_speed",
    "wind_direction",
)

FACT_RANGE_COLUMNS = (
    "date",
    "city",
    "country",
    "latitude",
    "longitude",
    "max_temperature",
    "min_temperature",
    "temperature",
    "max_pressure",
    "min_pressure",
    "pressure",
    "max_humidity",
    "min_humidity",
    "max_wind_speed",
    "humidity",
    "min_wind_speed",
    "wind_speed",
)


def _with_cities(daily: DataFrame, city_dim: DataFrame, country_list: Sequence[str] | None) -> DataFrame:
    dim = city_dim.select("city", "country", "latitude", "longitude")
    if country_list is not None:
        dim = dim.where(F.col("country").isin(list(country_list)))
    # Cities ⋈ daily on city only (a name in two countries fans out).
    return daily.join(dim, "city")


def _join_daily(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, ["city", "date"])  # J2-J5: inner on (city, date)
    return out


def join_fact_direction(
    city_dim: DataFrame,
    temperature: DataFrame,
    pressure: DataFrame,
    humidity: DataFrame,
    wind_speed: DataFrame,
    direction: DataFrame,
    country_list: Sequence[str] | None,
) -> DataFrame:
    """Date, country, city, latitude, longitude, the four daily means and
    the daily wind direction."""
    daily = _join_daily(
        [
            temperature.select("date", "city", "temperature"),
            pressure.select("date", "city", "pressure"),
            humidity.select("date", "city", "humidity"),
            wind_speed.select("date", "city", "wind_speed"),
            direction.select("date", "city", "wind_direction"),
        ]
    )
    return _with_cities(daily, city_dim, country_list).select(*FACT_DIRECTION_COLUMNS)


def join_fact_range(
    city_dim: DataFrame,
    temperature: DataFrame,
    pressure: DataFrame,
    humidity: DataFrame,
    wind_speed: DataFrame,
    country_list: Sequence[str] | None,
) -> DataFrame:
    """Date, city, country, latitude, longitude and max / min / mean of
    the four measures."""
    daily = _join_daily([temperature, pressure, humidity, wind_speed])
    return _with_cities(daily, city_dim, country_list).select(*FACT_RANGE_COLUMNS)


def fact_from_daily(
    city_dim: DataFrame,
    daily_parts: Sequence[DataFrame],
    columns: Sequence[str],
    country_list: Sequence[str] | None,
) -> DataFrame:
    """Join already-computed daily parts (each keyed by date, city and
    holding disjoint measures). Parts that come out of ``groupBy(date, city)``
    in the same job are hash-partitioned on those keys already, so their
    join adds no shuffle."""
    return _with_cities(_join_daily(list(daily_parts)), city_dim, country_list).select(*columns)


def union_readings(tables: dict[str, DataFrame], keep: Sequence[str] = ("datetime", "city")) -> DataFrame:
    """Stack long staging tables ``{attribute: (datetime, city, <attribute>)}``
    into one frame with one nullable column per attribute (``unionByName``
    with missing columns, no data copy beyond the scan)."""
    frames = []
    for attribute, df in tables.items():
        cols = [c for c in df.columns if c in keep or c == attribute or c == "seq"]
        frames.append(df.select(*cols))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _fact_aggregate(
    city_dim: DataFrame,
    rows: DataFrame,
    raw_specs: Sequence,
    partial_specs: Sequence,
    country_list: Sequence[str] | None,
    columns: Sequence[str],
    direction_order: Sequence[str] | None,
    rounding: str,
) -> DataFrame:
    """The single ``groupBy(date, city)`` behind both one-shuffle forms."""
    if country_list is not None:
        # Readings of cities that the country filter removes can never reach
        # the fact: drop them before the aggregate (a semi-join with the
        # bounded, filtered city list).
        wanted = city_dim.where(F.col("country").isin(list(country_list))).select("city")
        rows = rows.join(wanted, "city", "left_semi")
    extra = merge_partials(partial_specs, rounding)
    extra += [F.count(reading(s)).alias(f"_n_{s.out}") for s in raw_specs]
    decode = None
    if direction_order is not None:
        # Rows without a direction reading carry a null direction; they must
        # not count (a null would otherwise read as North).
        agg, decode = first_direction_agg(
            rows, list(direction_order), "wind_direction", only_when=F.col("wind_direction").isNotNull()
        )
        extra.append(agg.alias("_first"))
    daily = daily_many(rows, raw_specs, rounding=rounding, extra_aggs=extra)
    keep = None
    for s in list(partial_specs) + list(raw_specs):
        cond = F.col(f"_n_{s.out}") > 0
        keep = cond if keep is None else keep & cond
    if decode is not None:
        keep = keep & F.col("_first").isNotNull()
        daily = daily.withColumn("wind_direction", decode(F.col("_first")))
    return _with_cities(daily.where(keep), city_dim, country_list).select(*columns)


def fact_from_readings(
    city_dim: DataFrame,
    readings: DataFrame,
    specs: Sequence,
    country_list: Sequence[str] | None,
    columns: Sequence[str],
    direction_order: Sequence[str] | None = None,
    rounding: str = "half_up",
) -> DataFrame:
    """One-shuffle fact: every daily measure in one ``groupBy(date, city)``.

    ``readings`` holds ``datetime``, ``city`` and one nullable column per
    measure (see ``union_readings``); ``specs`` are ``daily.DailySpec``. With
    ``direction_order`` the first wind direction of the day is added. A
    ``(date, city)`` is kept only when every measure has at least one
    reading, which is what the inner joins of J2-J5 keep.
    """
    return _fact_aggregate(city_dim, readings, specs, (), country_list, columns, direction_order, rounding)


def fact_from_keyed(
    city_dim: DataFrame,
    rows: DataFrame,
    partial_specs: Sequence,
    raw_specs: Sequence,
    country_list: Sequence[str] | None,
    columns: Sequence[str],
    direction_order: Sequence[str] | None = None,
    rounding: str = "half_up",
) -> DataFrame:
    """One-shuffle fact from rows at a coarse key (e.g. one row per order)
    that carry raw readings (``raw_specs``) next to partial aggregates of
    finer readings (``partial_specs``, see ``daily.partials``). Same rows and
    values as the joins of the daily tables: a (date, city) is kept only when
    every measure has readings."""
    return _fact_aggregate(city_dim, rows, raw_specs, partial_specs, country_list, columns, direction_order, rounding)
