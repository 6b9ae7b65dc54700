"""Aggregates over daily facts (A5-A13) for a chosen measure (P5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratocast.schemas import Measure, measure


def _m(parameter: str | Measure) -> Measure:
    return parameter if isinstance(parameter, Measure) else measure(parameter)


# A5 -------------------------------------------------------------------------
def average_of(parameter: str | Measure) -> Column:
    """Average of the chosen daily mean (an unweighted average of rounded
    daily means, A13)."""
    return F.avg(F.col(_m(parameter).mean))


# A6 -------------------------------------------------------------------------
def range_of(parameter: str | Measure) -> Column:
    """MAX - MIN of the daily means (the 6-table fact has no min/max)."""
    c = F.col(_m(parameter).mean)
    return F.max(c) - F.min(c)


# A7 -------------------------------------------------------------------------
def maximum_of(parameter: str | Measure) -> Column:
    """MAX of the daily maxima."""
    return F.max(F.col(_m(parameter).high))


# A8 -------------------------------------------------------------------------
def minimum_of(parameter: str | Measure) -> Column:
    """MIN of the daily minima."""
    return F.min(F.col(_m(parameter).low))


# A9 -------------------------------------------------------------------------
def overall(df: DataFrame, *aggs: Column) -> DataFrame:
    """Global aggregate without a group key: always exactly one row, with
    nulls when nothing matched."""
    return df.agg(*aggs)


# A10 ------------------------------------------------------------------------
def yearly_average(df: DataFrame, parameter: str | Measure = "temperature", keys: tuple[str, ...] = ()) -> DataFrame:
    """Average of the chosen measure per year (and optional keys)."""
    return df.groupBy(*keys, F.year("date").cast("long").alias("year")).agg(
        average_of(parameter).alias("value")
    )


# A11 ------------------------------------------------------------------------
def drill_country_city(df: DataFrame, parameter: str | Measure = "temperature") -> DataFrame:
    """Drill path COUNTRY -> CITY: city rows, country subtotals and a grand
    total in one rollup; ``level`` is 0 for cities, 1 for countries, 3 for
    the total (``grouping_id``)."""
    return df.rollup("country", "city").agg(
        average_of(parameter).alias("value"),
        F.count(F.lit(1)).alias("days"),
        F.grouping_id().cast("long").alias("level"),
    )


# A12 ------------------------------------------------------------------------
def plain_aggregates(df: DataFrame, parameter: str | Measure = "temperature", keys: tuple[Column | str, ...] = ()) -> DataFrame:
    """The declared plain aggregates of a measure: sums of the mean, minimum
    and maximum columns, and avg / max / min of the mean."""
    m = _m(parameter)
    return df.groupBy(*keys).agg(
        F.sum(m.mean).alias("sum_mean"),
        F.sum(m.low).alias("sum_min"),
        F.sum(m.high).alias("sum_max"),
        F.avg(m.mean).alias("avg_mean"),
        F.max(m.mean).alias("max_mean"),
        F.min(m.mean).alias("min_mean"),
    )
