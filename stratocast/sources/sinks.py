"""Sinks and catalog.

The original sinks appended rows in fixed-size INSERT batches, so a retried
day duplicated its rows. Here every table is partitioned by ``date`` and
written with dynamic partition overwrite: re-running a day replaces exactly
that day's partition, and nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratocast.schemas import AGGREGATE_BATCH_ROWS, STAGING_BATCH_ROWS
from stratocast.sources.publish import read_current, replace_partitions


# S4 / S5 -------------------------------------------------------------------
def write_partitioned(
    df: DataFrame, path: str, partition_col: str = "date", fmt: str = "parquet", cluster: bool = True
) -> None:
    """Idempotent write: replace the partitions present in ``df``, keep the
    others (dynamic partition overwrite).

    ``cluster=True`` rebalances by the partition column first: few files, and
    adaptive execution splits a large value over several tasks."""
    out = df.hint("rebalance", partition_col) if cluster else df
    dynamic = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    dynamic.partitionBy(partition_col).format(fmt).save(path)


def with_date_partition(df: DataFrame, ts_col: str = "datetime") -> DataFrame:
    """Add the ``date`` partition column to a reading table."""
    return df.withColumn("date", F.to_date(F.col(ts_col)))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, staging: bool = True) -> None:
    """Append to a JDBC table in batches of 40,000 (staging) or 16,384
    (aggregates) rows, the original batch sizes."""
    batch = STAGING_BATCH_ROWS if staging else AGGREGATE_BATCH_ROWS
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch))
    df.write.mode("append").jdbc(url, table, properties=props)


# Fixed values, the tables' columns --------------------------------------------------------------
STAGING_DDL = {
    "city_attributes": "City STRING, Country STRING, Latitude DOUBLE, Longitude DOUBLE",
    "humidity": "datetime TIMESTAMP_NTZ, city STRING, humidity DOUBLE, date DATE",
    "pressure": "datetime TIMESTAMP_NTZ, city STRING, pressure DOUBLE, date DATE",
    "temperature": "datetime TIMESTAMP_NTZ, city STRING, temperature DOUBLE, date DATE",
    "weather_description": "datetime TIMESTAMP_NTZ, city STRING, weather_description STRING, date DATE",
    "wind_direction": "datetime TIMESTAMP_NTZ, city STRING, wind_direction DOUBLE, date DATE",
    "wind_speed": "datetime TIMESTAMP_NTZ, city STRING, wind_speed DOUBLE, date DATE",
}

AGGREGATE_DDL = {
    "cities": "id BIGINT, City STRING, Country STRING, Latitude DOUBLE, Longitude DOUBLE",
    "humidity_daily_average": "id BIGINT, city STRING, humidity DOUBLE, min_humidity DOUBLE, max_humidity DOUBLE, date DATE",
    "wind_speed_daily_average": "id BIGINT, city STRING, wind_speed DOUBLE, min_wind_speed DOUBLE, max_wind_speed DOUBLE, date DATE",
    "daily_temperature": "id BIGINT, city STRING, temperature DOUBLE, min_temperature DOUBLE, max_temperature DOUBLE, date DATE",
    "daily_pressure": "id BIGINT, city STRING, pressure DOUBLE, min_pressure DOUBLE, max_pressure DOUBLE, date DATE",
    "wind_direction_daily_average": "id BIGINT, city STRING, wind_direction STRING, date DATE",
}


def table_name(database: str, table: str, catalog: str | None = None) -> str:
    """Two- or three-part table name."""
    return f"{catalog}.{database}.{table}" if catalog else f"{database}.{table}"


def create_tables(
    spark: SparkSession,
    database: str,
    ddl: dict[str, str],
    location: str | None = None,
    drop_existing: bool = False,
    catalog: str | None = None,
) -> list[str]:
    """Create the database and its tables if missing (S6 staging, S7
    aggregates). Tables with a ``date`` column are partitioned by it. The
    original dropped the whole database first; here that happens only with
    ``drop_existing=True``."""
    whole = f"{catalog}.{database}" if catalog else database
    if drop_existing:
        spark.sql(f"DROP DATABASE IF EXISTS {whole} CASCADE")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {whole}{loc}")
    made = []
    for name, cols in ddl.items():
        part = " PARTITIONED BY (date)" if " date DATE" in cols else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table_name(database, name, catalog)} ({cols}) USING parquet{part}")
        made.append(table_name(database, name, catalog))
    return made


def matching(df: DataFrame, table: str) -> DataFrame:
    """The columns of ``df`` in the declared order of the catalog table; an error
    that names every difference if its columns or their types are others."""
    declared = {f.name.lower(): f for f in df.sparkSession.table(table).schema.fields}
    given = {f.name.lower(): f for f in df.schema.fields}
    wrong = [f"{n} is missing" for n in declared if n not in given] + [f"{n} is not declared" for n in given if n not in declared]
    wrong += [
        f"{n} is {given[n].dataType.simpleString()}, declared {f.dataType.simpleString()}"
        for n, f in declared.items()
        if n in given and given[n].dataType != f.dataType
    ]
    if wrong:
        raise ValueError(f"{table}: " + "; ".join(wrong))
    return df.select(*[F.col(f"`{given[n].name}`") for n in declared])


def insert_whole(df: DataFrame, table: str) -> str:
    """Replace all rows of a catalog table, by its two- or three-part name."""
    matching(df, table).write.mode("overwrite").insertInto(table)
    return table


def insert_days(df: DataFrame, table: str, days: Sequence) -> str:
    """Replace the ``date`` partitions of ``days`` in a catalog table by the rows
    of ``df``, which has no others; a day without rows loses its partition."""
    spark, rows = df.sparkSession, matching(df, table)
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        rows.hint("rebalance", "date").write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(key, before)
    # at most one row a day
    there = {r["date"] for r in rows.select("date").distinct().collect()}
    for d in days:
        if d not in there:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (date = DATE'{d.isoformat()}')")
    return table


# S9 ------------------------------------------------------------------------
def write_snapshot(df: DataFrame, path: str) -> None:
    """Materialise a fact as a Parquet snapshot (full refresh)."""
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, by: Sequence[str], sort_by: Sequence[str] | None = None) -> None:
    """Save a daily table bucketed by ``by`` (e.g. ``city``), so later joins
    of daily tables on ``(city, date)`` read co-partitioned buckets and skip
    the shuffle."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *by)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)


# S10 -----------------------------------------------------------------------
def profile(df: DataFrame, exact: bool = False, rsd: float = 0.05) -> DataFrame:
    """Per column: type, distinct count (HyperLogLog++ unless ``exact``), null
    count and row count, computed in one aggregate pass over ``df``.

    The result has one row per column: ``(column_name, data_type,
    distinct_count, null_count, row_count)``.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        dc = F.count_distinct(col) if exact else F.approx_count_distinct(col, rsd)
        aggs += [dc.alias(f"_d{i}"), F.count_if(col.isNull()).alias(f"_n{i}")]
    stats = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col(f"_d{i}").cast(T.LongType()).alias("distinct_count"),
            F.col(f"_n{i}").cast(T.LongType()).alias("null_count"),
            F.col("_rows").alias("row_count"),
        )
        for i, c in enumerate(df.columns)
    ]
    return stats.select(F.inline(F.array(*rows)))


#: Sketches of 2**16 registers: counts to about 6,000 as good as exact, beyond
#: that with a standard error of 0.4 %.
SKETCH_PRECISION = 16


def profile_sketches(df: DataFrame, by: str, precision: int = SKETCH_PRECISION) -> DataFrame:
    """A row for each value of ``by`` and each column: ``(by, column_name,
    data_type, sketch, null_count, row_count)``, the sketch standing for the
    column's distinct values. One aggregate pass; sketches are merged in part
    before the shuffle."""
    columns = [c for c in df.columns if c != by]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs += [F.hll_sketch_agg(col.cast("string"), precision).alias(f"_d{i}"), F.count_if(col.isNull()).alias(f"_n{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col(f"_d{i}").alias("sketch"),
            F.col(f"_n{i}").cast("long").alias("null_count"),
            F.col("_rows").alias("row_count"),
        )
        for i, c in enumerate(columns)
    ]
    return df.groupBy(F.col(f"`{by}`").alias(by)).agg(*aggs).select(by, F.inline(F.array(*rows)))


def refresh_profile(df: DataFrame, path: str, by: str) -> None:
    """Store the sketches of ``df``, in place of those that the table had for its
    values of ``by`` (the days or years that a run touched)."""
    made = profile_sketches(df, by)
    replace_partitions(df.sparkSession, path, [by], lambda to: made.coalesce(1).write.partitionBy(by).parquet(to))


def stored_profile(spark: SparkSession, path: str, by: str) -> DataFrame:
    """``profile`` of all that the sketches at ``path`` stand for, by merging them."""
    kept = read_current(spark, path, [by]).groupBy("column_name", "data_type")
    return kept.agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("long").alias("distinct_count"),
        F.sum("null_count").alias("null_count"),
        F.sum("row_count").alias("row_count"),
    )
