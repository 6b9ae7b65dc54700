"""Column functions (P1-P11): built-in Spark expressions only."""

from stratocast.functions.scalar import (
    bucket_order,
    compass,
    compass_code,
    compass_from_code,
    date_bucket,
    day_part,
    kelvin_to_fahrenheit,
    map_label,
    month_part,
    month_year,
    number_format,
    round_half,
    season,
    to_day,
    year_part,
)

__all__ = [
    "bucket_order",
    "compass",
    "compass_code",
    "compass_from_code",
    "date_bucket",
    "day_part",
    "kelvin_to_fahrenheit",
    "map_label",
    "month_part",
    "month_year",
    "number_format",
    "round_half",
    "season",
    "to_day",
    "year_part",
]
