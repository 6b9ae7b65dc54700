"""Weather tables derived from the driver's test tables (FIXTURES.md §4).

The original workflow's raw data (hourly CSV per city) is not available, so
every table of its data model is derived here, by Spark, from the given
tables, so that the work grows with them:

* long readings ``(datetime, city, value)``       <- ``events`` (ts, event_type, value)
* city dimension ``(city, country, lat, long)``  <- ``nation`` joined with ``region``
* line-level readings (temperature, humidity, wind speed)
      <- ``lineitem`` ⋈ ``orders`` ⋈ ``customer`` ⋈ ``nation``
* order-level readings (pressure, wind direction, ``seq`` = order key)
      <- ``orders`` ⋈ ``customer`` ⋈ ``nation``

Only the columns each reading needs are selected, so the Parquet scans read
just those columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stand-in parameters (FIXTURES.md §4).
STANDIN_COUNTRIES = ("AMERICA", "EUROPE")
STANDIN_COUNTRY = "AMERICA"
STANDIN_MONTH_YEAR = 199708
STANDIN_FORECAST_CITY = "NATION_1"
STANDIN_YEARS = (1996, 2000)
STANDIN_FILTERED_TOP_N = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table ``name``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# -- events: one long reading table -------------------------------------------
def event_readings(spark: SparkSession, sf_dir: str, attribute: str = "value") -> DataFrame:
    """``(datetime, city, <attribute>)`` from events: ts, event_type, value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("city"),
        F.col("value").alias(attribute),
    )


def event_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wind direction readings in degrees: ``(value * 37) % 360``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("city"),
        ((F.col("value") * F.lit(37)) % F.lit(360)).alias("wind_direction"),
    )


# -- city dimension -------------------------------------------------------------
def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(city, country, latitude, longitude)``: nation ⋈ region."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("r_regionkey").cast("double").alias("longitude"),
    )


def _order_city(spark: SparkSession, sf_dir: str, with_price: bool) -> DataFrame:
    o_cols = ["o_orderkey", "o_custkey", "o_orderdate"] + (["o_totalprice"] if with_price else [])
    o = table(spark, sf_dir, "orders").select(*o_cols)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    return o.join(cn, o.o_custkey == cn.c_custkey)


# -- order-level readings ---------------------------------------------------------
def order_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(datetime, city, seq, pressure, wind_direction)`` per order.

    ``seq`` (the order key) orders readings that share a timestamp, so the
    first direction of a day is well defined.
    """
    oc = _order_city(spark, sf_dir, with_price=True)
    return oc.select(
        F.col("o_orderdate").alias("datetime"),
        F.col("n_name").alias("city"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("pressure"),
        (F.col("o_totalprice") % F.lit(360)).alias("wind_direction"),
    )


# -- line-level readings ----------------------------------------------------------
def line_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(datetime, city, temperature, humidity, wind_speed)`` per line item.

    temperature = l_extendedprice (as Kelvin), humidity = l_quantity,
    wind_speed = l_discount * 100.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_quantity", "l_discount"
    )
    oc = _order_city(spark, sf_dir, with_price=False).select("o_orderkey", "o_orderdate", "n_name")
    return li.join(oc, li.l_orderkey == oc.o_orderkey).select(
        F.col("o_orderdate").alias("datetime"),
        F.col("n_name").alias("city"),
        F.col("l_extendedprice").alias("temperature"),
        F.col("l_quantity").alias("humidity"),
        (F.col("l_discount") * F.lit(100)).alias("wind_speed"),
    )


def staging_table(spark: SparkSession, sf_dir: str, attribute: str) -> DataFrame:
    """One long staging table ``(datetime, city, <attribute>)`` of the
    original data model (``seq`` is kept for wind direction)."""
    if attribute in ("temperature", "humidity", "wind_speed"):
        return line_readings(spark, sf_dir).select("datetime", "city", attribute)
    if attribute == "pressure":
        return order_readings(spark, sf_dir).select("datetime", "city", "pressure")
    if attribute == "wind_direction":
        return order_readings(spark, sf_dir).select("datetime", "city", "seq", "wind_direction")
    raise ValueError(f"no stand-in for attribute {attribute!r}")
