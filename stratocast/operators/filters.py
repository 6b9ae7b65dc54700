"""Filters and predicates.

All filters are plain predicates or semi-joins, so Catalyst pushes them to
the scans: a date filter on a timestamp becomes a range on the timestamp and,
on tables partitioned by ``date``, a partition filter.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratocast.functions.scalar import date_bucket, month_year


def _as_date(day: _dt.date | str) -> _dt.date:
    if isinstance(day, _dt.datetime):
        return day.date()
    if isinstance(day, _dt.date):
        return day
    return _dt.date.fromisoformat(str(day))


# F1 / I4 ----------------------------------------------------------------------
def one_day(df: DataFrame, day: _dt.date | str, ts_col: str = "datetime", partition_col: str | None = None) -> DataFrame:
    """Rows whose timestamp falls on ``day``.

    Written as a half-open timestamp range so the predicate reaches the
    Parquet reader's row-group statistics; with ``partition_col`` (a ``date``
    partition column) the same day also prunes partitions.
    """
    d = _as_date(day)
    start = _dt.datetime.combine(d, _dt.time())
    end = start + _dt.timedelta(days=1)
    ts = F.col(ts_col)
    # text literals cast to the column's own type: no Python or session
    # time-zone conversion is involved
    typ = df.schema[ts_col].dataType
    lo = F.lit(start.isoformat(sep=" ")).cast(typ)
    hi = F.lit(end.isoformat(sep=" ")).cast(typ)
    out = df.where((ts >= lo) & (ts < hi))
    if partition_col is not None:
        out = out.where(F.col(partition_col) == F.lit(d))
    return out


def day_range(df: DataFrame, start: _dt.date | str | None, end: _dt.date | str | None, date_col: str = "date") -> DataFrame:
    """``start <= date < end``; either bound may be None."""
    out = df
    if start is not None:
        out = out.where(F.col(date_col) >= F.lit(_as_date(start)))
    if end is not None:
        out = out.where(F.col(date_col) < F.lit(_as_date(end)))
    return out


# F2, F5, F6, F8 ---------------------------------------------------------------
def members(df: DataFrame, column: str, values: Iterable | None) -> DataFrame:
    """Keep rows whose ``column`` is one of ``values``; ``None`` keeps all."""
    return df if values is None else df.where(member_matches(column, values))


def member_matches(column: str, values: Iterable | None) -> Column:
    """Condition: ``column`` is one of ``values``; ``None`` is always true."""
    if values is None:
        return F.lit(True)
    return F.col(column).isin([values] if isinstance(values, (str, int)) else list(values))


def countries(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Country member list."""
    return members(df, "country", names)


def cities(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """city member list (None = all)."""
    return members(df, "city", names)


def months(df: DataFrame, month_numbers: Sequence[int] | None, date_col: str = "date") -> DataFrame:
    """F8: month member list (None = all)."""
    if month_numbers is None:
        return df
    return df.where(F.month(F.col(date_col)).isin(list(month_numbers)))


# F3 ---------------------------------------------------------------------------
def first_rows(df: DataFrame, index_col: str = "row_index") -> DataFrame:
    """Keep ``row_index = 1``."""
    return df.where(F.col(index_col) == 1)


# F4 ---------------------------------------------------------------------------
def month_year_matches(yyyymm: int | Sequence[int] | None, date_col: str = "date") -> Column:
    """Condition: month-year member(s), e.g. 201408. A single month is a date
    range, so that as a filter it can prune ``date`` partitions."""
    if yyyymm is None:
        return F.lit(True)
    if isinstance(yyyymm, int):
        y, m = divmod(yyyymm, 100)
        start = _dt.date(y, m, 1)
        end = _dt.date(y + (m == 12), m % 12 + 1, 1)
        return (F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end))
    return month_year(date_col).isin(list(yyyymm))


def month_year_is(df: DataFrame, yyyymm: int | Sequence[int] | None, date_col: str = "date") -> DataFrame:
    """Rows of the month-year member(s); None keeps all."""
    return df if yyyymm is None else df.where(month_year_matches(yyyymm, date_col))


# F7 ---------------------------------------------------------------------------
def year_range(df: DataFrame, first: int, last: int, date_col: str = "date") -> DataFrame:
    """Years ``first..last`` inclusive, as a date range."""
    return day_range(df, _dt.date(first, 1, 1), _dt.date(last + 1, 1, 1), date_col)


# F10 --------------------------------------------------------------------------
def selected_buckets(
    df: DataFrame,
    level: str,
    chosen: DataFrame | Sequence[str] | None,
    date_col: str = "date",
) -> DataFrame:
    """Cross-filter: keep rows whose date bucket (at ``level``) was chosen in
    another view. ``chosen`` is a list of bucket strings or a one-column
    DataFrame ``bucket`` (semi-join); ``None`` or empty means all."""
    if chosen is None:
        return df
    if isinstance(chosen, DataFrame):
        # keep a row when nothing was chosen, or when its bucket was chosen:
        # an uncorrelated EXISTS plus a correlated one, which Catalyst plans
        # as an existence join; no action runs while the plan is built
        keys = chosen.select(F.col(chosen.columns[0]).cast("string").alias("_bucket"))
        mine = date_bucket(F.col(date_col).outer(), level)
        return df.where(~keys.exists() | keys.where(F.col("_bucket") == mine).exists())
    values = list(chosen)
    if not values:
        return df
    return df.where(date_bucket(date_col, level).isin(values))
