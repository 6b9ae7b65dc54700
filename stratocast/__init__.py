"""stratocast — Spark-native weather analytics.

Hourly readings (one column per city in wide CSV files) are reshaped into long
reading tables, rolled up to daily min / mean / max per city, joined with a
city dimension into daily facts, and served through parameterised views
(averages, ranges, top/bottom cities, maps, calendar buckets, trends and
exponential-smoothing forecasts).

Every public operator is a lazy ``DataFrame -> DataFrame`` function built from
built-in Spark expressions, so Catalyst sees each view as one plan.
"""

from stratocast.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
