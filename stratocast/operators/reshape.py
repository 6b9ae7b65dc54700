"""Reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratocast.schemas import DATETIME_FORMAT

_NUMERIC = (T.DoubleType, T.FloatType, T.DecimalType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)


# R1 + R2 -----------------------------------------------------------------------
def wide_to_long(wide: DataFrame, attribute: str, index: str = "datetime", keep: Sequence[str] = ()) -> DataFrame:
    """Wide ``(datetime, <city 1>, <city 2>, ...)`` -> long
    ``(datetime, city, <attribute>)`` with missing readings dropped.

    ``unpivot`` is a narrow Expand: no shuffle. It keeps nulls, so the null
    (and NaN, for numbers) cells are filtered right after it. A frame without
    the index column (the city attributes file) passes through unchanged (R4).
    ``keep`` columns are carried next to the index (e.g. the source file).
    """
    if index not in wide.columns:
        return wide
    ids = [index, *keep]
    city_cols = [c for c in wide.columns if c not in ids]
    if not city_cols:
        return wide.select(*ids).where(F.lit(False)).withColumn("city", F.lit(None).cast("string")).withColumn(
            attribute, F.lit(None).cast("double")
        )
    # unpivot needs one value type; numeric cities widen to double.
    types = {type(wide.schema[c].dataType) for c in city_cols}
    numeric = all(issubclass(t, _NUMERIC) for t in types)
    vt = "double" if numeric else "string"
    frame = wide.select(*[F.col(c) for c in ids], *[F.col(f"`{c}`").cast(vt).alias(c) for c in city_cols])
    # quoted, since a city's name may hold a dot
    long = frame.unpivot(ids, [F.col(f"`{c}`") for c in city_cols], "city", attribute)
    present = F.col(attribute).isNotNull()
    if numeric:
        present = present & ~F.isnan(F.col(attribute))
    return long.where(present)


# R3 ------------------------------------------------------------------------------
def parse_datetime(df: DataFrame, column: str = "datetime", strict: bool = True) -> DataFrame:
    """Parse ``yyyy-MM-dd HH:mm:ss`` text to TIMESTAMP_NTZ.

    ``strict=True`` raises on bad text (ANSI ``to_timestamp_ntz``);
    ``strict=False`` turns bad text into null for a quarantine path.
    """
    if column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, (T.TimestampNTZType, T.TimestampType)):
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    fmt = F.lit(DATETIME_FORMAT)
    parsed = (
        F.to_timestamp_ntz(F.col(column), fmt)
        if strict
        else F.try_to_timestamp(F.col(column), fmt).cast("timestamp_ntz")
    )
    return df.withColumn(column, parsed)


# R5 ------------------------------------------------------------------------------
def select_renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Column selection with renames, e.g. the city dimension's
    ``City -> city``."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


# R6 ------------------------------------------------------------------------------
def measure_names(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    name_col: str = "measure_name",
    value_col: str = "value",
) -> DataFrame:
    """Measure Names / Measure Values: each of ``measures`` (already
    aggregated columns) becomes a row ``(keys..., name, value)``."""
    return df.select(*keys, *[F.col(f"`{m}`").cast("double").alias(m) for m in measures]).unpivot(
        list(keys), [F.col(f"`{m}`") for m in measures], name_col, value_col
    )
