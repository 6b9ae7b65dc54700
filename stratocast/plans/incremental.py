"""Day-by-day processing (I1-I6): ledger, staging, daily aggregates.

``run_day`` is the whole daily stage order as one driver function:

    next date (I1) -> guards (I3) -> [bootstrap: tables + cities]
    -> stage every attribute of the day folder (I5: one scan, one write)
    -> recompute the daily aggregates of every touched day
    -> rebuild the fact partitions of those days (J6, J7)
    -> append the date to the ledger (I2, last, so a failed aggregate is
       retried the next run instead of skipped)

Writes are idempotent: staging is partitioned by ``(date, load_date)`` and
aggregates by ``date``; a rerun replaces its partitions instead of duplicating
rows, and a failure leaves the old or the new ones (``sources.publish``). Of two
runs of one day the ledger takes one (``sources.ledger``). With a ``database``
the rows of the touched days are also inserted, by name, into catalog tables. A
reading that arrives late in another day's folder lands in its own ``date``
partition and that day is recomputed from all of its rows.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratocast.operators import daily as D
from stratocast.operators import facts as J
from stratocast.operators.keys import with_dense_id
from stratocast.schemas import ATTRIBUTES, BOOTSTRAP_DATE, DIRECTION_TABLE, FACT_COUNTRIES, LEDGER_SEED_DATE, STOP_DATE
from stratocast.sources import csv_wide as CSV
from stratocast.sources import sinks as SK
from stratocast.sources.ledger import append_ledger, last_entry, read_ledger
from stratocast.sources.publish import delete, exists, glob, move, read_current, replace_partitions
from stratocast.sources.sinks import write_partitioned

# Attributes with a daily aggregate, and the table each feeds.
AGGREGATED = {
    "humidity": "humidity_daily_average",
    "wind_speed": "wind_speed_daily_average",
    "temperature": "daily_temperature",
    "pressure": "daily_pressure",
    "wind_direction": "wind_direction_daily_average",
}


#: The part of a staging partition that holds a whole day folder; the stream's
#: parts are files.
WHOLE = "day"


@dataclass(frozen=True)
class Layout:
    raw_root: str  # <raw_root>/input_<day>/<attribute>/*.csv
    warehouse: str  # staging/, aggregates/, ledger/
    database: str | None = None  # tables are kept in the catalog, too: <database> and <database>_staging
    catalog: str | None = None

    def staging(self, attribute: str) -> str:
        return os.path.join(self.warehouse, "staging", attribute)

    def aggregate(self, table: str) -> str:
        return os.path.join(self.warehouse, "aggregates", table)

    @property
    def pending(self) -> str:
        return os.path.join(self.warehouse, "pending")

    @property
    def ledger(self) -> str:
        return os.path.join(self.warehouse, "ledger")


# I1 / I2 -----------------------------------------------------------------------
def next_day(spark: SparkSession, ledger_path: str, seed: _dt.date = LEDGER_SEED_DATE) -> _dt.date:
    """The day after the ledger's last entry (by sequence, not the largest
    date); the seed + 1 day when the ledger is missing or empty."""
    return (last_entry(spark, ledger_path).date or seed) + _dt.timedelta(days=1)


def next_day_from_text(spark: SparkSession, path: str, seed: _dt.date = LEDGER_SEED_DATE) -> _dt.date:
    """Same rule on a text ledger (one ``yyyy-MM-dd`` per line, blank lines
    ignored, last line wins). The file is one split, read in line order."""
    if not exists(spark, path):
        return seed + _dt.timedelta(days=1)
    lines = spark.read.text(path)
    kept = lines.select(F.trim("value").alias("v"), F.monotonically_increasing_id().alias("pos")).where(F.col("v") != "")
    last = kept.agg(F.max_by("v", "pos").alias("d")).first()["d"]
    return (_dt.date.fromisoformat(last) if last else seed) + _dt.timedelta(days=1)


# Staging (S1, R1-R3, S4) ---------------------------------------------------------
def _load_partitions(spark: SparkSession, layout: Layout, attribute: str, load_days: Sequence[_dt.date]) -> list:
    """Staging partitions of an attribute that came from these day folders."""
    days = "{" + ",".join(sorted({d.isoformat() for d in load_days})) + "}"
    return glob(spark, f"{layout.staging(attribute)}/date=*/load_date={days}")


def _dates(partitions: Sequence) -> set[_dt.date]:
    return {_dt.date.fromisoformat(p.getParent().getName().removeprefix("date=")) for p in partitions}


def stage_folders(spark: SparkSession, layout: Layout, attribute: str, load_days: Sequence[_dt.date]) -> set[_dt.date]:
    """Read the day folders ``load_days`` of one attribute in one job and
    write them to staging in place of what these folders gave before; each
    row's ``load_date`` comes from its source file's folder. Returns the dates
    of the old and the new readings (the touched days). A missing folder, or
    one without files, is a FileNotFoundError."""
    for d in load_days:
        folder = CSV.day_folder(layout.raw_root, d, attribute)
        if not exists(spark, folder):
            raise FileNotFoundError(f"no day folder {folder}")
    if not load_days:
        return set()
    long = CSV.read_wide(spark, CSV.day_folders_glob(layout.raw_root, load_days, attribute), attribute, source_col="_source")
    load_date = F.to_date(F.regexp_extract(F.col("_source"), r"input_(\d{4}-\d{2}-\d{2})/", 1))
    staged = long.withColumn("date", F.to_date("datetime")).withColumn("load_date", load_date).withColumn("part", F.lit(WHOLE)).drop("_source")
    old = _load_partitions(spark, layout, attribute, load_days)
    touched = _dates(old)
    if touched:
        _remember(spark, layout, touched)
    by = ["date", "load_date"]
    gone = [f"{p.getParent().getName()}/{p.getName()}" for p in old]
    replace_partitions(spark, layout.staging(attribute), by, lambda to: write_partitioned_multi(staged, to, [*by, "part"]), gone)
    return touched | _dates(_load_partitions(spark, layout, attribute, load_days))


def stage_attributes(spark: SparkSession, layout: Layout, attributes: Sequence[str], load_days: Sequence[_dt.date]) -> set[_dt.date]:
    """``stage_folders`` for several attributes (I5): one scan of all their
    folders and one write, partitioned by attribute, whose folders then take
    their places attribute by attribute. A staging table's files have a column
    for each attribute of the run; those of the others are null."""
    for d in load_days:
        for a in attributes:
            folder = CSV.day_folder(layout.raw_root, d, a)
            if not exists(spark, folder):
                raise FileNotFoundError(f"no day folder {folder}")
            if not glob(spark, f"{folder}/*.csv"):
                raise FileNotFoundError(f"no .csv files below {folder}")
    if not load_days or not attributes:
        return set()
    long = CSV.read_attributes(spark, CSV.day_folders_glob(layout.raw_root, load_days, attributes), attributes)
    old = {a: _load_partitions(spark, layout, a, load_days) for a in attributes}
    touched = _dates([p for ps in old.values() for p in ps])
    if touched:
        _remember(spark, layout, touched)
    gone = {a: [f"{p.getParent().getName()}/{p.getName()}" for p in old[a]] for a in attributes}
    _publish_staged(spark, layout, long.withColumn("part", F.lit(WHOLE)), {a: gone[a] for a in attributes}, ["date", "load_date"])
    return touched | _dates([p for a in attributes for p in _load_partitions(spark, layout, a, load_days)])


def _publish_staged(spark: SparkSession, layout: Layout, long: DataFrame, gone: dict[str, list[str]], by: Sequence[str]) -> set[_dt.date]:
    """Write the readings of several attributes (``CSV.attribute_readings`` with a
    column part) by one job, and let the partitions of ``by`` take their places
    in the attributes' staging tables. Returns the dates written."""
    load_date = F.to_date(F.regexp_extract(F.col("source"), r"input_(\d{4}-\d{2}-\d{2})/", 1))
    staged = long.withColumn("date", F.to_date("datetime")).withColumn("load_date", load_date).drop("source")
    together = os.path.join(layout.warehouse, "staging", "_beside", uuid.uuid4().hex)
    write_partitioned_multi(staged, together, ["attribute", "date", "load_date", "part"])
    dates = _dates(glob(spark, f"{together}/attribute=*/date=*/load_date=*"))
    for a in gone:
        take = lambda to, a=a: move(spark, f"{together}/attribute={a}", to)
        replace_partitions(spark, layout.staging(a), by, take, gone[a])
    delete(spark, glob(spark, together))
    return dates


def stage_lines(spark: SparkSession, layout: Layout, lines: DataFrame, attributes: Sequence[str]) -> set[_dt.date]:
    """Stage the lines ``(value, file, at, block)`` of whole files that have
    arrived (ST2): each file's readings are a partition of their own below its
    dates and load date, so what came before is not read again, and a file that
    comes twice is there once. Returns the dates of the new readings."""
    long = CSV.attribute_readings(lines, attributes, "the arrived files")
    part = F.concat(F.lit("f"), F.substring(F.sha2(F.col("source"), 256), 1, 24))
    return _publish_staged(spark, layout, long.withColumn("part", part), {a: [] for a in attributes}, ["date", "load_date", "part"])


def _remember(spark: SparkSession, layout: Layout, touched: set[_dt.date]) -> None:
    """Keep the touched days until the day is done: a rerun after a failure still
    recomputes days whose readings have gone."""
    days = spark.createDataFrame([(d,) for d in sorted(touched)], "date date")
    days.coalesce(1).write.mode("append").parquet(layout.pending)


def stage_folder(spark: SparkSession, layout: Layout, load_day: _dt.date, attribute: str) -> set[_dt.date]:
    """One day folder of one attribute (see ``stage_folders``)."""
    return stage_folders(spark, layout, attribute, [load_day])


def write_partitioned_multi(df: DataFrame, path: str, cols: Sequence[str]) -> None:
    """Dynamic-overwrite write, rebalanced by the partition columns: few files
    per partition, while a day with a third of all readings is split over
    several tasks by size."""
    dynamic = df.hint("rebalance", *cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    dynamic.partitionBy(*cols).parquet(path)


# Aggregation (A1-A4, W3, S5) -------------------------------------------------------
def staged_rows(spark: SparkSession, layout: Layout, attribute: str, days: Sequence[_dt.date]) -> DataFrame:
    """All staged readings of ``days`` (partition-pruned on ``date``)."""
    by = ["date", "load_date", "part"] if glob(spark, f"{layout.staging(attribute)}/date=*/load_date=*/part=*") else ["date", "load_date"]
    return read_current(spark, layout.staging(attribute), by).where(F.col("date").isin(list(days)))


def aggregate_days(
    spark: SparkSession, layout: Layout, days: Sequence[_dt.date], attributes: Sequence[str] | None = None
) -> dict[str, str]:
    """Recompute and overwrite the daily tables of ``days``; with
    ``attributes``, only the tables fed by those (the ones that received
    readings)."""
    written = {}
    if not days:
        return written
    for attribute, table in AGGREGATED.items():
        if attributes is not None and attribute not in attributes:
            continue
        if attributes is None and not exists(spark, layout.staging(attribute)):
            continue
        rows = staged_rows(spark, layout, attribute, days)
        if attribute == "wind_direction":
            out = D.daily_direction(rows)
        elif attribute == "temperature":
            out = D.daily_temperature(rows)
        else:
            out = D.daily_stats(rows, attribute)
        _replace_days(spark, out, layout.aggregate(table), days)
        written[table] = layout.aggregate(table)
    return written


def _replace_days(spark: SparkSession, out: DataFrame, path: str, days: Sequence[_dt.date]) -> None:
    """Replace the partitions of ``days``; days that have no rows any more go."""
    wanted = [f"date={d.isoformat()}" for d in days]
    replace_partitions(spark, path, ["date"], lambda to: write_partitioned(out, to, "date"), wanted)


# Facts (J6, J7), maintained per day --------------------------------------------------
FACT_INPUTS = ("daily_temperature", "daily_pressure", "humidity_daily_average", "wind_speed_daily_average")


def refresh_facts(
    spark: SparkSession, layout: Layout, days: Sequence[_dt.date], country_list=FACT_COUNTRIES
) -> dict[str, str]:
    """Rebuild the fact partitions of ``days`` from the stored daily tables.

    A fact row of day d depends only on the daily rows of day d, so the
    joins read just those ``date`` partitions of each table (partition
    pruning) and replace just those fact partitions: the fact is maintained
    incrementally instead of being re-extracted in full."""
    if not days or not all(exists(spark, layout.aggregate(t)) for t in (*FACT_INPUTS, "cities")):
        return {}  # no bootstrap yet, or a run with fewer attributes
    day_list = list(days)
    daily = {t: read_current(spark, layout.aggregate(t)).where(F.col("date").isin(day_list)) for t in FACT_INPUTS}
    cities = spark.read.parquet(layout.aggregate("cities"))
    args = (daily["daily_temperature"], daily["daily_pressure"], daily["humidity_daily_average"], daily["wind_speed_daily_average"])
    written = {}
    _replace_days(spark, J.join_fact_range(cities, *args, country_list), layout.aggregate("fact_range"), days)
    written["fact_range"] = layout.aggregate("fact_range")
    if exists(spark, layout.aggregate(DIRECTION_TABLE)):
        direction = read_current(spark, layout.aggregate(DIRECTION_TABLE)).where(F.col("date").isin(day_list))
        fact = J.join_fact_direction(cities, *args, direction, country_list)
        _replace_days(spark, fact, layout.aggregate("fact_direction"), days)
        written["fact_direction"] = layout.aggregate("fact_direction")
    return written


# Bootstrap (S2, S6/S7) ------------------------------------------------------------
def load_cities(spark: SparkSession, layout: Layout, day: _dt.date) -> None:
    folder = CSV.day_folder(layout.raw_root, day, "city_attributes")
    if not exists(spark, folder):
        raise FileNotFoundError(f"no city file in {folder}")
    CSV.read_city_attributes(spark, folder).write.mode("overwrite").parquet(layout.staging("city_attributes"))
    cities = spark.read.parquet(layout.staging("city_attributes"))
    cities.write.mode("overwrite").parquet(layout.aggregate("cities"))
    if layout.database is not None:
        raw = cities.select(*[F.col(c.lower()).alias(c) for c in ("City", "Country", "Latitude", "Longitude")])
        SK.insert_whole(raw, SK.table_name(f"{layout.database}_staging", "city_attributes", layout.catalog))
        SK.insert_whole(with_dense_id(raw, ["City", "Country"]), SK.table_name(layout.database, "cities", layout.catalog))


def create_catalog_tables(spark: SparkSession, layout: Layout) -> None:
    """The databases and their tables, below the warehouse, if missing."""
    for name, ddl in ((f"{layout.database}_staging", SK.STAGING_DDL), (layout.database, SK.AGGREGATE_DDL)):
        SK.create_tables(spark, name, ddl, os.path.join(layout.warehouse, "catalog", name), catalog=layout.catalog)


def insert_catalog_days(spark: SparkSession, layout: Layout, days: Sequence[_dt.date], attributes: Sequence[str]) -> list[str]:
    """The rows of ``days`` of each staging and daily table that the run fed,
    inserted by name into their ``date`` partitions. A daily row's id is its
    date's number times 2**32 plus its place among the date's cities, so a rerun
    of one day changes no other day's ids."""
    done = []
    name = lambda db, t: SK.table_name(db, t, layout.catalog)
    for attribute in attributes:
        columns = [c for c in ("datetime", "city", attribute, "date")]
        rows = staged_rows(spark, layout, attribute, days).select(*columns)
        done.append(SK.insert_days(rows, name(f"{layout.database}_staging", attribute), days))
        table = AGGREGATED.get(attribute)
        if table is not None:
            daily = read_current(spark, layout.aggregate(table)).where(F.col("date").isin(list(days)))
            # a date has as many rows as there are cities
            place = F.row_number().over(Window.partitionBy("date").orderBy("city"))
            made = daily.withColumn("id", F.unix_date("date").cast("long") * (1 << 32) + place)
            done.append(SK.insert_days(made, name(layout.database, table), days))
    return done


# K1 --------------------------------------------------------------------------------
def publish_with_ids(spark: SparkSession, layout: Layout, table: str, out_path: str) -> DataFrame:
    """Serve an aggregate table with the surrogate ``id`` (first column,
    1..N in (date, city) order; cities in city order), written as a full
    snapshot. Ids are assigned on the whole table at publish time, so reruns
    of single days, which replace partitions, never leave gaps or duplicates."""
    df = spark.read.parquet(layout.aggregate(table)) if table == "cities" else read_current(spark, layout.aggregate(table))
    order = ["date", "city"] if "date" in df.columns else ["city", "country"]
    with_dense_id(df, order).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


# I3 / I6 -------------------------------------------------------------------------
def run_day(
    spark: SparkSession,
    layout: Layout,
    day: _dt.date | None = None,
    attributes: Sequence[str] = ATTRIBUTES,
    bootstrap: _dt.date = BOOTSTRAP_DATE,
    stop: _dt.date = STOP_DATE,
) -> dict | None:
    """Process one day folder end to end; None when the stop date is
    reached (the ledger does not advance past it).

    A missing attribute folder is a FileNotFoundError before anything is
    written, and any failure leaves the ledger as it is, so the day is tried
    again. A rerun replaces everything that the day's folder gave before."""
    d = day or next_day(spark, layout.ledger)
    if d >= stop:
        return None
    days, written = _process(spark, layout, [d], attributes, bootstrap)
    return {"day": d, "touched": days, "tables": written}


def run_days(
    spark: SparkSession,
    layout: Layout,
    days: Sequence[_dt.date],
    attributes: Sequence[str] = ATTRIBUTES,
    bootstrap: _dt.date = BOOTSTRAP_DATE,
) -> dict:
    """Several day folders at once (a backfill): one staging job and one recomputation of all touched days, with ``run_day``'s guarantees."""
    touched, written = _process(spark, layout, sorted(days), attributes, bootstrap)
    return {"days": sorted(days), "touched": touched, "tables": written}


def _process(spark: SparkSession, layout: Layout, load_days: Sequence[_dt.date], attributes: Sequence[str], bootstrap: _dt.date):
    for d in load_days:
        for attribute in attributes:
            folder = CSV.day_folder(layout.raw_root, d, attribute)
            if not exists(spark, folder):
                raise FileNotFoundError(f"no day folder {folder}")
    seen = last_entry(spark, layout.ledger)
    if layout.database is not None:
        create_catalog_tables(spark, layout)
    if bootstrap in load_days:
        load_cities(spark, layout, bootstrap)
    touched = stage_attributes(spark, layout, attributes, load_days)
    if exists(spark, layout.pending):
        touched |= {r["date"] for r in spark.read.schema("date date").parquet(layout.pending).distinct().collect()}
    days = sorted(touched)
    written = aggregate_days(spark, layout, days, attributes)
    written.update(refresh_facts(spark, layout, days))
    if layout.database is not None and days:
        insert_catalog_days(spark, layout, days, attributes)
    append_ledger(spark, layout.ledger, *load_days, after=seen)
    delete(spark, glob(spark, layout.pending))
    return days, written
