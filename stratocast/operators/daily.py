"""Daily roll-ups of long reading tables.

Each daily table is one ``groupBy(date, city)``: Spark aggregates partially
inside every map task (so a city that holds a third of all readings is
reduced before the shuffle), shuffles only the partial rows on the group key
and finishes the aggregate. Several measures that share a reading table are
computed in the same pass (one scan, one shuffle).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratocast.functions.scalar import (
    compass,
    compass_code,
    compass_from_code,
    kelvin_to_fahrenheit,
    exact_mean,
    exact_sum,
    finite,
    merged_sum,
    round_half,
    to_day,
)
from stratocast.operators.filters import one_day

# Compass codes below one step of a packed order key (8 sectors).
_CODES = 8
# Stands for a null order key when packed: after every 64-bit one.
_NO_KEY = 10**20


@dataclass(frozen=True)
class DailySpec:
    """One daily measure: source column, output name, optional conversion."""

    source: str
    out: str
    convert: Callable[[Column], Column] | None = None


def reading(spec: DailySpec) -> Column:
    """The (converted) value; null, so no reading, where it is NaN or infinite."""
    c = F.col(spec.source).cast("double")
    return finite(spec.convert(c) if spec.convert is not None else c)


def _rounded(spec: DailySpec, total: Column, count: Column, low: Column, high: Column, rounding: str) -> list[Column]:
    """Mean, min and max as whole numbers, min <= mean <= max."""
    mean = F.least(F.greatest(exact_mean(total, count), low), high)
    return [
        round_half(mean, 0, rounding).alias(spec.out),
        round_half(low, 0, rounding).alias(f"min_{spec.out}"),
        round_half(high, 0, rounding).alias(f"max_{spec.out}"),
    ]


def daily_many(
    readings: DataFrame,
    specs: Sequence[DailySpec],
    day: _dt.date | str | None = None,
    rounding: str = "half_up",
    ts_col: str = "datetime",
    city_col: str = "city",
    extra_aggs: Sequence[Column] = (),
) -> DataFrame:
    """``(date, city, m, min_m, max_m, ...)`` for every spec in one aggregate.

    ``day`` restricts the input to one day (incremental mode, I4); ``None``
    processes every day. Means, minima and maxima are rounded to integers.
    NaN and infinite readings count as missing in all of them.
    """
    df = readings if day is None else one_day(readings, day, ts_col)
    aggs: list[Column] = []
    for spec in specs:
        v = reading(spec)
        aggs += _rounded(spec, exact_sum(v), F.count(v), F.min(v), F.max(v), rounding)
    aggs += list(extra_aggs)
    return df.groupBy(to_day(ts_col).alias("date"), F.col(city_col).alias("city")).agg(*aggs)


def partials(readings: DataFrame, keys: Sequence[str | Column], specs: Sequence[DailySpec]) -> DataFrame:
    """Partial aggregates per ``keys``: sum, count, min and max of each
    (converted) measure. Used to pre-aggregate fine-grained readings to a
    coarser key before a join, so the join moves one row per key instead of
    one per reading; ``merge_partials`` finishes them per day."""
    aggs: list[Column] = []
    for spec in specs:
        v = reading(spec)
        aggs += [
            exact_sum(v).alias(f"_s_{spec.out}"),
            F.count(v).alias(f"_c_{spec.out}"),
            F.min(v).alias(f"_lo_{spec.out}"),
            F.max(v).alias(f"_hi_{spec.out}"),
        ]
    return readings.groupBy(*keys).agg(*aggs)


def merge_partials(specs: Sequence[DailySpec], rounding: str = "half_up") -> list[Column]:
    """Aggregate expressions turning ``partials`` columns into the daily
    mean / min / max (and a ``_n_<out>`` reading count)."""
    out: list[Column] = []
    for spec in specs:
        o = spec.out
        count, low, high = F.sum(f"_c_{o}"), F.min(f"_lo_{o}"), F.max(f"_hi_{o}")
        out += _rounded(spec, merged_sum(f"_s_{o}"), count, low, high, rounding)
        out.append(F.coalesce(count, F.lit(0)).alias(f"_n_{o}"))
    return out


def daily_stats(
    readings: DataFrame,
    source: str,
    out: str | None = None,
    convert: Callable[[Column], Column] | None = None,
    day: _dt.date | str | None = None,
    rounding: str = "half_up",
    ts_col: str = "datetime",
) -> DataFrame:
    """Generic daily mean / min / max of one measure."""
    return daily_many(readings, [DailySpec(source, out or source, convert)], day, rounding, ts_col)


# A1 ----------------------------------------------------------------------------
def daily_humidity(readings: DataFrame, day=None, rounding: str = "half_up") -> DataFrame:
    """humidity_daily_average: (date, city, humidity, min_humidity, max_humidity)."""
    return daily_stats(readings, "humidity", day=day, rounding=rounding)


# A2 ----------------------------------------------------------------------------
def daily_wind_speed(readings: DataFrame, day=None, rounding: str = "half_up") -> DataFrame:
    """wind_speed_daily_average."""
    return daily_stats(readings, "wind_speed", day=day, rounding=rounding)


# A3 ----------------------------------------------------------------------------
def daily_temperature(readings: DataFrame, day=None, rounding: str = "half_up") -> DataFrame:
    """daily_temperature in °F: each Kelvin reading is converted, then
    aggregated and rounded."""
    return daily_stats(readings, "temperature", convert=kelvin_to_fahrenheit, day=day, rounding=rounding)


# A4 ----------------------------------------------------------------------------
def daily_pressure(readings: DataFrame, day=None, rounding: str = "half_up") -> DataFrame:
    """daily_pressure."""
    return daily_stats(readings, "pressure", day=day, rounding=rounding)


# W1-W3 -------------------------------------------------------------------------
def _is_packable(readings: DataFrame, order_by: Sequence[str]) -> bool:
    if len(order_by) != 1:
        return False
    dtype = readings.schema[order_by[0]].dataType
    return isinstance(
        dtype, (T.TimestampType, T.TimestampNTZType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    )


def _order_long(readings: DataFrame, col: str) -> Column:
    dtype = readings.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        # wall-clock microseconds, independent of the session time zone
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(col))
    return F.col(col).cast("long")


def first_direction_agg(
    readings: DataFrame,
    order_by: Sequence[str],
    deg_col: str,
    only_when: Column | None = None,
) -> tuple[Column, Callable[[Column], Column]]:
    """Aggregate expression picking the compass code of the first reading of
    a group, and the decoder turning its result into the direction name.

    With a single integral or timestamp order key, key and code are packed in
    one decimal (``key * 8 + code``): ``min`` of it is a fixed-width hash
    aggregate with map-side combine, no sort. A null key comes last. Otherwise the aggregate is the
    ``min`` of a struct (sort-based aggregate). Ties on the key go to the
    sector listed first. Rows where ``only_when`` is false are ignored.
    """
    code = compass_code(deg_col)

    def guard(c: Column) -> Column:
        return c if only_when is None else F.when(only_when, c)

    if _is_packable(readings, order_by):
        # as decimals, so that no 64-bit key overflows
        key = _order_long(readings, order_by[0]).cast("decimal(21,0)")
        packed = (F.coalesce(key, F.lit(str(_NO_KEY)).cast("decimal(21,0)")) * F.lit(_CODES) + code).cast("decimal(23,0)")
        return F.min(guard(packed)), lambda m: compass_from_code(F.pmod(m, F.lit(_CODES)))
    parts = [(F.col(c).isNull(), F.col(c)) for c in order_by]
    key = F.struct(*[p.alias(f"k{i}_{j}") for i, pair in enumerate(parts) for j, p in enumerate(pair)], code.alias("code"))
    return F.min(guard(key)), lambda m: compass_from_code(m.getField("code"))


def daily_direction(
    readings: DataFrame,
    day: _dt.date | str | None = None,
    order_by: Sequence[str] = ("datetime",),
    method: str = "aggregate",
    deg_col: str = "wind_direction",
    ts_col: str = "datetime",
) -> DataFrame:
    """One compass direction per (date, city) — the direction of the
    day's first reading (by ``order_by``, then sector order).

    ``method="aggregate"`` (default) is a single hash aggregate;
    ``method="window"`` is the literal ``row_number() = 1`` / ``nth_value``
    form (W1, W2, F3), which Spark plans with a partial WindowGroupLimit.
    """
    df = readings if day is None else one_day(readings, day, ts_col)
    if method == "aggregate":
        agg, decode = first_direction_agg(df, list(order_by), deg_col)
        return (
            df.groupBy(to_day(ts_col).alias("date"), F.col("city"))
            .agg(agg.alias("_first"))
            .select("date", "city", decode(F.col("_first")).alias("wind_direction"))
        )
    if method == "window":
        return first_per_day_window(df, order_by, deg_col, ts_col)
    raise ValueError(f"unknown method {method!r}")


def _day_window(order_by: Sequence[str]) -> Window:
    return Window.partitionBy("city", "date").orderBy(*[F.col(c).asc_nulls_last() for c in order_by], F.col("_code"))


def _with_direction(readings: DataFrame, order_by: Sequence[str], deg_col: str, ts_col: str) -> DataFrame:
    return readings.select(
        to_day(ts_col).alias("date"),
        F.col("city"),
        *[F.col(c) for c in order_by if c not in ("city",)],
        compass(deg_col).alias("direction"),
        compass_code(deg_col).alias("_code"),
    )


def with_first_direction(
    readings: DataFrame,
    order_by: Sequence[str] = ("datetime",),
    deg_col: str = "wind_direction",
    ts_col: str = "datetime",
) -> DataFrame:
    """Every reading with its ``direction`` and ``direction_of_wind``,
    the value of ``nth_value(direction, 1) over (partition by city, date
    order by ...)``: the day's first direction next to each reading.

    Planned without the window: the first direction per (city, date) comes
    from the hash aggregate of ``daily_direction`` (one row per day and city)
    and is joined back on (date, city). A day holding a third of all readings
    is thus never sorted in one task: the aggregate combines it map-side, and
    the join is chosen by AQE from the aggregate's measured output (broadcast
    when small, otherwise a sort-merge join whose skewed partitions AQE
    splits). No size check runs ahead: counting the per-day table would
    execute the aggregate twice.
    """
    firsts = daily_direction(readings, order_by=order_by, deg_col=deg_col, ts_col=ts_col).withColumnRenamed(
        "wind_direction", "direction_of_wind"
    )
    base = readings.select(
        to_day(ts_col).alias("date"),
        F.col("city"),
        *[F.col(c) for c in order_by if c != "city"],
        compass(deg_col).alias("direction"),
    )
    first = firsts.select(F.col("date").alias("_date"), F.col("city").alias("_city"), "direction_of_wind")
    # a null city or date is a group like any other
    out = base.join(first, F.col("date").eqNullSafe(F.col("_date")) & F.col("city").eqNullSafe(F.col("_city")))
    return out.select("date", "city", *[c for c in order_by if c != "city"], "direction", "direction_of_wind")


def first_per_day_window(
    readings: DataFrame,
    order_by: Sequence[str] = ("datetime",),
    deg_col: str = "wind_direction",
    ts_col: str = "datetime",
) -> DataFrame:
    """W2 + F3: ``row_number()`` over (city, date), keep ``row_index = 1``.
    On that row ``nth_value(direction, 1)`` (W1) is the row's own direction,
    so only the rank function remains and Spark adds a partial
    WindowGroupLimit below the shuffle (a hot day is cut to one row per task
    before it moves)."""
    df = _with_direction(readings, order_by, deg_col, ts_col)
    ranked = df.select("date", "city", "direction", F.row_number().over(_day_window(order_by)).alias("row_index"))
    return ranked.where(F.col("row_index") == 1).select("date", "city", F.col("direction").alias("wind_direction"))
