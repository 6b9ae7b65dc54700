"""Schemas, fixed values and the measure registry (P5).

Values marked FIXED must stay equal to the original workflow's definitions for
results to match; they are listed plainly and in their original order.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED values (must equal the original workflow's definitions)
# --------------------------------------------------------------------------

# Reading attributes, one folder and one staging table each.
ATTRIBUTES = (
    "pressure",
    "temperature",
    "humidity",
    "weather_description",
    "wind_direction",
    "wind_speed",
)
CITY_ATTRIBUTES = "city_attributes"

# Timestamp text format of the ``datetime`` column in the wide files.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Compass sectors, inclusive bounds in degrees, tested in this order.
# A value outside all of them (including null and the gaps) is North.
COMPASS_SECTORS = (
    ("NorthWest", 292.6, 337.5),
    ("West", 247.6, 292.5),
    ("SouthWest", 202.6, 247.5),
    ("South", 157.6, 202.5),
    ("SouthEast", 112.6, 157.5),
    ("East", 67.6, 112.5),
    ("NorthEast", 22.6, 67.5),
)
COMPASS_OTHERWISE = "North"

# Season by month number; any other month is Winter.
SEASONS = (
    ("Fall", 9, 11),
    ("Spring", 3, 5),
    ("Summer", 6, 8),
)
SEASON_OTHERWISE = "Winter"

# Kelvin -> Fahrenheit: (t - 273.15) * 9 / 5 + 32
KELVIN_OFFSET = 273.15

# Ledger seed: with no ledger, the first day processed is the seed + 1 day.
LEDGER_SEED_DATE = _dt.date(2017, 10, 30)
BOOTSTRAP_DATE = _dt.date(2017, 10, 31)
STOP_DATE = _dt.date(2017, 11, 30)  # exclusive: 2017-11-29 is the last day

# Countries kept by both fact queries.
FACT_COUNTRIES = ("United States", "Canada")

# Dashboard defaults.
DEFAULT_MONTH_YEAR = 201408
DEFAULT_COUNTRY = "United States"
DEFAULT_FORECAST_CITY = "Minneapolis"
DEFAULT_YEAR_RANGE = (2013, 2017)
TOP_N = 10

# Map label: "(min°F  ,  max°F)"
MAP_LABEL_FORMAT = "(%s°F  ,  %s°F)"

# Measure names in the order of the climate series view.
SERIES_MEASURE_ORDER = ("maximum", "minimum", "average")
# Forecast indicator order.
FORECAST_INDICATOR_ORDER = ("Actual", "Estimate")

# Insert batch sizes of the original row-by-row sinks (JDBC batchsize).
STAGING_BATCH_ROWS = 40000
AGGREGATE_BATCH_ROWS = 16384

# --------------------------------------------------------------------------
# Measure registry (P5): parameter value -> daily fact columns
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    name: str  # canonical parameter value
    mean: str  # daily mean column
    low: str  # daily minimum column
    high: str  # daily maximum column
    unit: str


MEASURES = {
    "temperature": Measure("temperature", "temperature", "min_temperature", "max_temperature", "°F"),
    "pressure": Measure("pressure", "pressure", "min_pressure", "max_pressure", "hPa"),
    "humidity": Measure("humidity", "humidity", "min_humidity", "max_humidity", "%"),
    "wind speed": Measure("wind speed", "wind_speed", "min_wind_speed", "max_wind_speed", "m/s"),
}


def measure(parameter: str) -> Measure:
    """Resolve a measure parameter ("Temperature", "wind speed", ...).

    Both spellings used by the dashboards are accepted: the lookup ignores
    case and treats ``_`` as a space. Resolution happens at plan time, so the
    plan reads only the chosen column.
    """
    key = parameter.strip().lower().replace("_", " ")
    if key not in MEASURES:
        raise ValueError(f"unknown measure {parameter!r}; expected one of {sorted(MEASURES)}")
    return MEASURES[key]


DATE_LEVELS = ("year", "quarter", "month", "day")

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------

CITY_SCHEMA = T.StructType(
    [
        T.StructField("City", T.StringType(), True),
        T.StructField("Country", T.StringType(), True),
        T.StructField("Latitude", T.DoubleType(), True),
        T.StructField("Longitude", T.DoubleType(), True),
    ]
)

CITIES_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
    ]
)


def reading_schema(attribute: str) -> T.StructType:
    value_type = T.StringType() if attribute == "weather_description" else T.DoubleType()
    return T.StructType(
        [
            T.StructField("datetime", T.TimestampNTZType(), True),
            T.StructField("city", T.StringType(), True),
            T.StructField(attribute, value_type, True),
        ]
    )


def daily_schema(column: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("date", T.DateType(), True),
            T.StructField("city", T.StringType(), True),
            T.StructField(column, T.DoubleType(), True),
            T.StructField(f"min_{column}", T.DoubleType(), True),
            T.StructField(f"max_{column}", T.DoubleType(), True),
        ]
    )


DIRECTION_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("wind_direction", T.StringType(), True),
    ]
)

# Daily aggregate table -> (source attribute, output column)
DAILY_TABLES = {
    "humidity_daily_average": ("humidity", "humidity"),
    "wind_speed_daily_average": ("wind_speed", "wind_speed"),
    "daily_temperature": ("temperature", "temperature"),
    "daily_pressure": ("pressure", "pressure"),
}
DIRECTION_TABLE = "wind_direction_daily_average"
