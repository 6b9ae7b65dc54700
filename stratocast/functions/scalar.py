"""Scalar column functions P1-P11.

All of them return ``Column`` expressions made of built-in functions, so they
stay inside whole-stage codegen and fold into whatever plan uses them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratocast.schemas import (
    COMPASS_OTHERWISE,
    COMPASS_SECTORS,
    DATE_LEVELS,
    KELVIN_OFFSET,
    MAP_LABEL_FORMAT,
    SEASON_OTHERWISE,
    SEASONS,
)

# Readings below the limit are summed in whole multiples of these (see exact_sum).
SUM_QUANTA = (2.0**13, 2.0**-20, 2.0**-53)
SUM_LIMIT = 2.0**46


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 ------------------------------------------------------------------------
def to_day(ts: Column | str) -> Column:
    """Timestamp -> date. On a filter, Catalyst turns ``to_day(ts) = d`` into a
    range on ``ts`` that reaches the Parquet scan."""
    return F.to_date(_col(ts))


# P2 ------------------------------------------------------------------------
def kelvin_to_fahrenheit(k: Column | str) -> Column:
    """(k - 273.15) * 9 / 5 + 32, as a double."""
    return (_col(k).cast("double") - F.lit(KELVIN_OFFSET)) * F.lit(9) / F.lit(5) + F.lit(32)


# P3 ------------------------------------------------------------------------
def round_half(c: Column | str, scale: int = 0, mode: str = "half_up") -> Column:
    """Round to ``scale`` decimals, once.

    ``mode="half_up"`` rounds ties away from zero (SQL ``ROUND``);
    ``mode="half_even"`` is banker's rounding (``bround``).
    """
    v = _col(c)
    if mode == "half_up":
        return F.round(v, scale)
    if mode == "half_even":
        return F.bround(v, scale)
    raise ValueError(f"unknown rounding mode {mode!r}")


def finite(c: Column | str) -> Column:
    """The value as a double; null for NaN and infinity, which are no readings."""
    v = _col(c).cast("double")
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def exact_sum(c: Column | str) -> Column:
    """Sum of doubles (an aggregate, as a struct for ``exact_mean``), the same
    whatever order the tasks finish in, and as exact as the doubles.

    Each value is cut into whole multiples of three quanta, which are summed as
    longs: they hold every double of less than ``SUM_LIMIT`` that is 1 or more
    in full, smaller ones to 2**-53, and 2**30 of them. What is beyond the limit
    is summed as it is. NaN and infinity are left out."""
    v = finite(c)
    near, rest, parts = F.abs(v) < F.lit(SUM_LIMIT), v, []
    for quantum in SUM_QUANTA:
        whole = F.rint(rest / F.lit(quantum))
        parts.append(F.when(near, whole).cast("long"))
        rest = rest - whole * F.lit(quantum)
    return F.struct(*[F.sum(p).alias(f"p{i}") for i, p in enumerate(parts)], F.sum(F.when(~near, v)).alias("far"))


def merged_sum(c: Column | str) -> Column:
    """The sum of several ``exact_sum`` results."""
    return F.struct(*[F.sum(_col(c)[f]).alias(f) for f in ("p0", "p1", "p2", "far")])


def exact_mean(total: Column, count: Column) -> Column:
    """The mean as a double from an ``exact_sum`` and the count of its finite
    values; null for none."""
    near = None
    for i, quantum in enumerate(SUM_QUANTA):
        part = F.coalesce(total[f"p{i}"], F.lit(0)).cast("double") * F.lit(quantum)
        near = part if near is None else near + part
    return F.when(count > 0, (near + F.coalesce(total["far"], F.lit(0.0))) / count)


# P4 ------------------------------------------------------------------------
COMPASS_NAMES = tuple(name for name, _, _ in COMPASS_SECTORS) + (COMPASS_OTHERWISE,)


def _compass_case(deg: Column | str, label) -> Column:
    d = _col(deg).cast("double")
    expr = None
    for i, (name, low, high) in enumerate(COMPASS_SECTORS):
        cond = (d >= F.lit(low)) & (d <= F.lit(high))
        out = label(i, name)
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr.otherwise(label(len(COMPASS_SECTORS), COMPASS_OTHERWISE))


def compass(deg: Column | str) -> Column:
    """Degrees -> one of 8 compass names; nulls and gaps are North."""
    return _compass_case(deg, lambda i, name: F.lit(name))


def compass_code(deg: Column | str) -> Column:
    """Same sectors as ``compass`` but as a small int (index into
    ``COMPASS_NAMES``). A fixed-width code keeps a 'first of day' aggregate in
    the hash aggregate instead of a sort aggregate."""
    return _compass_case(deg, lambda i, name: F.lit(i))


def compass_from_code(code: Column | str) -> Column:
    names = F.array(*[F.lit(n) for n in COMPASS_NAMES])
    return F.element_at(names, _col(code).cast("int") + F.lit(1))


# P6, P7, P9 ------------------------------------------------------------------
def year_part(d: Column | str) -> Column:
    return F.year(_col(d))


def month_part(d: Column | str) -> Column:
    return F.month(_col(d))


def day_part(d: Column | str) -> Column:
    return F.dayofmonth(_col(d))


def season(d: Column | str) -> Column:
    """Season name of a date's month (no year in it: December and the same
    year's January are both Winter)."""
    m = F.month(_col(d))
    expr = None
    for name, low, high in SEASONS:
        cond = (m >= F.lit(low)) & (m <= F.lit(high))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(SEASON_OTHERWISE))


def _check_level(level: str) -> str:
    lv = level.strip().lower()
    if lv not in DATE_LEVELS:
        raise ValueError(f"unknown date level {level!r}; expected one of {DATE_LEVELS}")
    return lv


def date_bucket(d: Column | str, level: str = "year") -> Column:
    """Date-level bucket as a string: year, season ("quarter"), month number
    or day of month. The level is a Python argument, so only one branch is
    planned."""
    lv = _check_level(level)
    if lv == "year":
        return F.year(_col(d)).cast("string")
    if lv == "quarter":
        return season(d)
    if lv == "month":
        return F.month(_col(d)).cast("string")
    return F.dayofmonth(_col(d)).cast("string")


def bucket_order(d: Column | str, level: str = "year") -> Column:
    """Numeric sort key next to the string bucket ("2" before "10")."""
    lv = _check_level(level)
    if lv == "year":
        return F.year(_col(d))
    if lv == "quarter":
        m = F.month(_col(d))
        order = None
        for i, (_, low, high) in enumerate(SEASONS):
            cond = (m >= F.lit(low)) & (m <= F.lit(high))
            order = F.when(cond, F.lit(i)) if order is None else order.when(cond, F.lit(i))
        return order.otherwise(F.lit(len(SEASONS)))
    if lv == "month":
        return F.month(_col(d))
    return F.dayofmonth(_col(d))


# P8 ------------------------------------------------------------------------
def month_year(d: Column | str) -> Column:
    """yyyyMM as an int, e.g. 201408."""
    return F.year(_col(d)) * F.lit(100) + F.month(_col(d))


# P10 -----------------------------------------------------------------------
def _number_text(c: Column) -> Column:
    v = c.cast("double")
    return F.when(v == F.floor(v), v.cast("bigint").cast("string")).otherwise(v.cast("string"))


def map_label(low: Column | str, high: Column | str) -> Column:
    """"(min°F  ,  max°F)"; the unit text is printed whatever the measure.
    Whole numbers print without a decimal part."""
    return F.format_string(MAP_LABEL_FORMAT, _number_text(_col(low)), _number_text(_col(high)))


# P11 -----------------------------------------------------------------------
def number_format(c: Column | str, decimals: int = 1) -> Column:
    """#,##0.0 style text."""
    return F.format_number(_col(c), decimals)
