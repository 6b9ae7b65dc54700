"""Daily tables and facts over the stand-in readings (FIXTURES.md §4).

Three plans give the same rows:

* ``form="keyed"`` (default): line readings are pre-aggregated per order
  (sum, count, min, max; lines of an order sit together, so the map-side
  combine is effective), joined once to the per-order rows (pressure,
  direction, city, date), and rolled up by (date, city) in one aggregate.
  orders ⋈ customer runs once and lineitem moves as one row per order.
* ``form="stacked"``: line and order readings stacked (union) and
  aggregated in one pass (``facts.fact_from_readings``), the generic form
  for long staging tables.
* ``form="join"``: the five daily tables computed separately and joined, as
  the original query text does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast.functions.scalar import kelvin_to_fahrenheit
from stratocast.operators import daily as D
from stratocast.operators import facts as J
from stratocast.sources import standin as S

TEMPERATURE = D.DailySpec("temperature", "temperature", kelvin_to_fahrenheit)
PRESSURE = D.DailySpec("pressure", "pressure")
HUMIDITY = D.DailySpec("humidity", "humidity")
WIND_SPEED = D.DailySpec("wind_speed", "wind_speed")
FACT_SPECS = (TEMPERATURE, PRESSURE, HUMIDITY, WIND_SPEED)

# Stand-in "first reading of the day" order: the order key.
DIRECTION_ORDER = ("seq",)


def daily_tables(spark: SparkSession, sf_dir: str, day=None) -> dict[str, DataFrame]:
    """The five daily aggregate tables, each from its own staging table."""
    st = lambda a: S.staging_table(spark, sf_dir, a)
    return {
        "daily_temperature": D.daily_temperature(st("temperature"), day),
        "daily_pressure": D.daily_pressure(st("pressure"), day),
        "humidity_daily_average": D.daily_humidity(st("humidity"), day),
        "wind_speed_daily_average": D.daily_wind_speed(st("wind_speed"), day),
        "wind_direction_daily_average": D.daily_direction(st("wind_direction"), day, order_by=DIRECTION_ORDER),
    }


LINE_SPECS = (TEMPERATURE, HUMIDITY, WIND_SPEED)


def keyed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: datetime, city, seq, pressure, wind_direction and
    the partial aggregates of its line readings (null when it has none)."""
    li = S.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey"),
        F.col("l_extendedprice").alias("temperature"),
        F.col("l_quantity").alias("humidity"),
        (F.col("l_discount") * F.lit(100)).alias("wind_speed"),
    )
    parts = D.partials(li, ["l_orderkey"], LINE_SPECS)
    orders = S.order_readings(spark, sf_dir)
    return orders.join(parts, orders.seq == parts.l_orderkey, "left").drop("l_orderkey")


def all_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line- and order-level readings stacked, one nullable column per measure."""
    return S.line_readings(spark, sf_dir).unionByName(S.order_readings(spark, sf_dir), allowMissingColumns=True)


def fact_direction(spark: SparkSession, sf_dir: str, countries=S.STANDIN_COUNTRIES, form: str = "keyed") -> DataFrame:
    """J6 over the stand-in readings."""
    dim = S.cities(spark, sf_dir)
    if form == "join":
        t = daily_tables(spark, sf_dir)
        return J.join_fact_direction(
            dim,
            t["daily_temperature"],
            t["daily_pressure"],
            t["humidity_daily_average"],
            t["wind_speed_daily_average"],
            t["wind_direction_daily_average"],
            countries,
        )
    if form == "keyed":
        return J.fact_from_keyed(
            dim, keyed_rows(spark, sf_dir), LINE_SPECS, (PRESSURE,), countries, J.FACT_DIRECTION_COLUMNS, DIRECTION_ORDER
        )
    if form == "stacked":
        return J.fact_from_readings(
            dim, all_readings(spark, sf_dir), FACT_SPECS, countries, J.FACT_DIRECTION_COLUMNS, DIRECTION_ORDER
        )
    raise ValueError(f"unknown form {form!r}")


def fact_range(spark: SparkSession, sf_dir: str, countries=S.STANDIN_COUNTRIES, form: str = "keyed") -> DataFrame:
    """J7 over the stand-in readings."""
    dim = S.cities(spark, sf_dir)
    if form == "join":
        t = daily_tables(spark, sf_dir)
        return J.join_fact_range(
            dim,
            t["daily_temperature"],
            t["daily_pressure"],
            t["humidity_daily_average"],
            t["wind_speed_daily_average"],
            countries,
        )
    if form == "keyed":
        return J.fact_from_keyed(dim, keyed_rows(spark, sf_dir), LINE_SPECS, (PRESSURE,), countries, J.FACT_RANGE_COLUMNS)
    if form == "stacked":
        return J.fact_from_readings(dim, all_readings(spark, sf_dir), FACT_SPECS, countries, J.FACT_RANGE_COLUMNS)
    raise ValueError(f"unknown form {form!r}")
