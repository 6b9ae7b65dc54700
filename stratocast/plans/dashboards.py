"""The three dashboards: groups of views sharing parameters (Q1-Q9).

A dashboard reads one daily fact. ``materialise`` writes that fact once as a
Parquet snapshot (S9, full refresh) and returns a DataFrame over the
snapshot, so the views of a dashboard scan the small snapshot instead of
recomputing the fact from the readings each time; this is what the original
extract did.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stratocast import schemas as K
from stratocast.plans import views as V
from stratocast.sources.sinks import write_snapshot


def materialise(fact: DataFrame, path: str) -> DataFrame:
    """Write ``fact`` to ``path`` (overwrite) and read it back."""
    write_snapshot(fact, path)
    return fact.sparkSession.read.parquet(path)


def weather_dashboard(
    fact: DataFrame,
    parameter: str = "Temperature",
    month_year: int = K.DEFAULT_MONTH_YEAR,
    country: str = K.DEFAULT_COUNTRY,
    n: int = K.TOP_N,
    scope: str = "global",
) -> dict[str, DataFrame]:
    """Q1-Q6 over the 6-table fact with the shared parameter, month and
    country filters."""
    return {
        "average_value": V.average_value(fact, parameter, month_year, country),
        "range_value": V.range_value(fact, parameter, month_year, country),
        "top_cities": V.top_cities(fact, parameter, n, "top", month_year, country, scope),
        "bottom_cities": V.top_cities(fact, parameter, n, "bottom", month_year, country, scope),
        "consistent_cities": V.consistent_cities(fact, parameter, n, month_year, country, scope),
        "map_data": V.map_data(fact, parameter, month_year, country),
    }


def climate_dashboard(
    fact: DataFrame,
    parameter: str = "temperature",
    level: str = "year",
    city_list: Sequence[str] | None = None,
    month_list: Sequence[int] | None = None,
    chosen_buckets=None,
) -> dict[str, DataFrame]:
    """Q7 and Q8 over the 5-table fact; ``chosen_buckets`` is the selection
    made in the series view (cross-filter, None = all)."""
    return {
        "climate_series": V.climate_series(fact, parameter, level, city_list, month_list),
        "climate_map": V.climate_map(fact, parameter, level, city_list, chosen_buckets),
    }


def forecast_dashboard(
    fact: DataFrame,
    city_list: Sequence[str] | None = (K.DEFAULT_FORECAST_CITY,),
    years: tuple[int, int] = K.DEFAULT_YEAR_RANGE,
    horizon: int = 3,
) -> dict[str, DataFrame]:
    """Q9: yearly temperature with forecast and trend line."""
    return {
        "forecast": V.temperature_forecast(fact, "temperature", city_list, years, horizon),
        "trend": V.temperature_trend(fact, "temperature", city_list, years),
    }
