"""Wide CSV readings and the city attributes file.

Layout of the raw input: ``<root>/input_<yyyy-MM-dd>/<attribute>/*.csv``;
each file has a ``datetime`` column followed by one column per city.

Files of one folder may list the cities in different orders. Spark's CSV
reader maps columns by position, so reading them together would silently
swap cities. The lines are therefore read as text and joined by file to a
table of the files' first lines; each line is parsed with as many columns as
its header has (``from_csv``) and its cells are paired with the header's names
by position. No list of files or headers comes to the driver, only the few
different numbers of columns.
Values are read as text; missing-value markers become null and everything
else is cast strictly (ANSI), so real garbage fails the load, or goes to a
table of rejected lines (``read_quarantined``).
"""

from __future__ import annotations

import datetime as _dt
import os
import re
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratocast.operators.reshape import parse_datetime, select_renamed, wide_to_long
from stratocast.schemas import CITY_SCHEMA, DATETIME_FORMAT

# FIXED: pandas' default missing-value markers (read_csv ``na_values``
# default), which the original loader relied on.
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

TEXT_ATTRIBUTES = ("weather_description",)


def day_folder(root: str, day: _dt.date | str, attribute: str) -> str:
    """``<root>/input_<day>/<attribute>``."""
    d = day.isoformat() if isinstance(day, _dt.date) else str(day)
    return os.path.join(root, f"input_{d}", attribute)


def list_csv_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Every ``.csv`` file below ``path`` (a file listing only; no data is
    read)."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
    return sorted(reader.text(paths).inputFiles())


def csv_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names of one CSV file (reads its first line only)."""
    return tuple(spark.read.option("header", "true").csv(file).columns)


def _by_header(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files by their header. One job reads all of them as text and keeps
    the line at each file's start; the headers are parsed as CSV, one read for
    each different one."""
    if not files:
        raise FileNotFoundError("no .csv files")
    lines = spark.read.text(list(files)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), "_metadata.file_block_start"
    )
    first = lines.where("file_block_start = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))
    by_line = first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    out: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in by_line:
        out[csv_header(spark, row.files[0])] += row.files
    return out


def _read_group(spark: SparkSession, files: Sequence[str], header: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .csv(list(files))
    )


def _clean_value(attribute: str, col: str = "value") -> F.Column:
    v = F.col(col)
    missing = v.isNull() | F.trim(v).isin(list(MISSING_MARKERS))
    if attribute in TEXT_ATTRIBUTES:
        return F.when(~missing, v)
    # strict cast: under ANSI mode a non-number raises
    return F.when(~missing, F.trim(v).cast("double"))


#: A comma outside quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value, file, at, block): the lines of every CSV file below ``path`` that
    are not blank."""
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
    lines = reader.text([path] if isinstance(path, str) else list(path)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return lines.where(F.trim("value") != "")


def _headers(lines: DataFrame) -> DataFrame:
    """(file, header, width): the first line of each file and its columns."""
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    return first.withColumn("width", F.size(F.split("header", _COMMA)))


def _cells(text: str, width: int, strict: bool) -> F.Column:
    """The cells of a CSV line as an array; null for a line that is not of this
    width, unless ``strict``, when it fails."""
    names = [f"c{i}" for i in range(width)]
    fields = ", ".join(f"{n} string" for n in names)
    if strict:
        parsed = F.from_csv(F.col(text), fields, {"mode": "FAILFAST", "escape": '"'})
        return F.array(*[parsed[n] for n in names])
    parsed = F.from_csv(F.col(text), f"{fields}, bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "escape": '"'})
    return F.when(parsed["bad"].isNull(), F.array(*[parsed[n] for n in names]))


def _parsed(lines: DataFrame, where: str, strict: bool) -> tuple[DataFrame | None, list[str]]:
    """(file, line, names, cells) of the data lines of the files with a
    ``datetime`` column, and the different headers without one. A line that
    repeats its file's header is none. ``lines`` are as of ``_text``."""
    headers = _headers(lines)
    dated = F.array_contains(F.split("header", _COMMA), "datetime") | F.col("header").contains('"datetime"')
    # at most a row for each number of columns, and for each header of a table without datetime
    kinds = headers.groupBy("width", F.when(~dated, F.col("header")).alias("other")).agg(F.count("*").alias("n")).collect()
    if not kinds:
        raise FileNotFoundError(f"no .csv files below {where}")
    parts = []
    for width in sorted({k.width for k in kinds if k.other is None}):
        own = headers.where(dated & (F.col("width") == width)).select("file", "header", _cells("header", width, True).alias("names"))
        rows = lines.join(own, "file").where(F.col("value") != F.col("header"))
        parts.append(rows.select("file", F.col("value").alias("line"), "names", _cells("value", width, strict).alias("cells")))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out, sorted(k.other for k in kinds if k.other is not None)


def _readings(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(datetime, city, value) as text, a row for each cell."""
    datetime = F.element_at("cells", F.array_position("names", "datetime").cast("int"))
    pairs = F.explode(F.arrays_zip("names", "cells")).alias("p")
    long = parsed.select(datetime.alias("datetime"), *keep, pairs).where(F.col("p.names") != "datetime")
    return long.select("datetime", F.col("p.names").alias("city"), *keep, F.col("p.cells").alias("value"))


def _undated(spark: SparkSession, path: str | Sequence[str], header: str) -> DataFrame:
    """The rows of the files with this header, by its names."""
    lines = _text(spark, path)
    own = _headers(lines).where(F.col("header") == header).select("file")
    columns = csv_columns(spark, header)
    fields = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = lines.join(own, "file").where(F.col("value") != header)
    parsed = F.from_csv("value", fields.toDDL(), {"mode": "FAILFAST", "escape": '"'}).alias("r")
    return rows.select("file", parsed).select("file", "r.*")


def csv_columns(spark: SparkSession, header: str) -> list[str]:
    """The names in one CSV line."""
    width = len(re.split(_COMMA, header))
    return spark.range(1).select(F.lit(header).alias("header")).select(_cells("header", width, True).alias("c")).first().c


def read_wide(
    spark: SparkSession,
    path: str | Sequence[str],
    attribute: str,
    strict_datetime: bool = True,
    check_headers: bool = True,
    source_col: str | None = None,
) -> DataFrame:
    """S1 + R1-R4: every CSV below ``path`` as long readings
    ``(datetime, city, <attribute>)`` with missing readings dropped.

    ``check_headers=False`` reads all files as one group, without a look at the
    headers but one (a file whose header differs then fails the load).
    ``source_col`` adds each reading's source file path, so many folders can be
    staged in one job. Tables without ``datetime`` pass as they are (R4).
    """
    keep = [] if source_col is None else [source_col]
    if not check_headers:
        files = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").option("header", "true")
        wide = _read_group(spark, [path] if isinstance(path, str) else path, files.csv(path).columns)
        parts = [wide if source_col is None else wide.withColumn(source_col, F.input_file_name())]
        if "datetime" in wide.columns:
            parts = [wide_to_long(parts[0], "value", keep=keep)]
    else:
        parsed, others = _parsed(_text(spark, path), path, strict=True)
        parts = []
        if parsed is not None:
            parts.append(_readings(parsed.withColumnRenamed("file", source_col or "file"), keep))
        for header in others:
            rows = _undated(spark, path, header)
            parts.append(rows.drop("file") if source_col is None else rows.withColumnRenamed("file", source_col))
    out = None
    for p in parts:
        if "datetime" in p.columns:
            p = p.select("datetime", "city", *keep, _clean_value(attribute).alias(attribute))
            p = parse_datetime(p.where(F.col(attribute).isNotNull()), "datetime", strict_datetime)
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def read_attributes(spark: SparkSession, path: str | Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """The readings of several attributes' folders in one scan (see
    ``attribute_readings``)."""
    return attribute_readings(_text(spark, path), attributes, str(path))


def attribute_readings(lines: DataFrame, attributes: Sequence[str], where: str) -> DataFrame:
    """The readings of the lines ``(value, file, at, block)`` of whole files of
    several attributes: ``(datetime, city, attribute, source)`` and a column for
    each attribute, null in the rows of the others. ``at`` orders a file's lines;
    the attribute is the name of the file's folder."""
    parsed, others = _parsed(lines, where, strict=True)
    if others:
        raise ValueError(f"files without a datetime column: {others[0]}")
    folder = F.element_at(F.split("source", "/"), -2)
    long = _readings(parsed.withColumnRenamed("file", "source"), ["source"]).withColumn("attribute", folder)
    values = [F.when(F.col("attribute") == a, _clean_value(a)).alias(a) for a in attributes]
    long = long.select("datetime", "city", "attribute", "source", *values)
    some = F.exists(F.array(*[F.col(a).isNotNull() for a in attributes]), lambda x: x)
    return parse_datetime(long.where(some), "datetime")


def read_quarantined(spark: SparkSession, path: str | Sequence[str], attribute: str) -> tuple[DataFrame, DataFrame]:
    """The readings ``(datetime, city, <attribute>)`` of the lines that are
    right, and the rejected ones, ``(file, line, reason)``: "columns" (more or
    fewer than the header has), "datetime" (no timestamp) or "value" (a cell that
    is no number and no missing marker). A line is rejected as a whole."""
    parsed, _ = _parsed(_text(spark, path), path, strict=False)
    if parsed is None:
        raise ValueError(f"no files with a datetime column below {path}")
    at = F.array_position("names", "datetime").cast("int")
    stamp = F.try_to_timestamp(F.element_at("cells", at), F.lit(DATETIME_FORMAT))
    readable = F.lit(True)
    if attribute not in TEXT_ATTRIBUTES:

        def fine(c: F.Column) -> F.Column:
            return c.isNull() | F.trim(c).isin(list(MISSING_MARKERS)) | F.trim(c).try_cast("double").isNotNull()

        readable = F.forall(F.arrays_zip("names", "cells"), lambda p: (p["names"] == "datetime") | fine(p["cells"]))
    reason = F.when(F.col("cells").isNull(), "columns").when(stamp.isNull(), "datetime").when(~readable, "value")
    judged = parsed.withColumn("reason", reason)
    long = _readings(judged.where("reason is null"), []).select("datetime", "city", _clean_value(attribute).alias(attribute))
    good = parse_datetime(long.where(F.col(attribute).isNotNull()), "datetime")
    return good, judged.where("reason is not null").select("file", "line", "reason")


def day_folders_glob(root: str, days, attribute: str | Sequence[str]) -> str:
    """One glob for several day folders of one attribute or several:
    ``<root>/input_{d1,d2,...}/<attribute>``."""
    if not isinstance(attribute, str):
        attribute = "{" + ",".join(sorted(attribute)) + "}"
    names = sorted({d.isoformat() if isinstance(d, _dt.date) else str(d) for d in days})
    inner = names[0] if len(names) == 1 else "{" + ",".join(names) + "}"
    return os.path.join(root, f"input_{inner}", attribute)


def read_day(spark: SparkSession, root: str, day: _dt.date | str, attribute: str, **kw) -> DataFrame:
    """One day's folder of one attribute."""
    return read_wide(spark, day_folder(root, day, attribute), attribute, **kw)


def read_city_attributes(spark: SparkSession, path: str) -> DataFrame:
    """S2 + R5: the city file as ``(city, country, latitude, longitude)``."""
    files = list_csv_files(spark, path)
    parts = [_read_group(spark, group, header) for header, group in _by_header(spark, files).items()]
    raw = parts[0]
    for more in parts[1:]:
        raw = raw.unionByName(more)
    # columns by the header's names, whatever their order
    raw = raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in CITY_SCHEMA.fields])
    return select_renamed(raw, {"City": "city", "Country": "country", "Latitude": "latitude", "Longitude": "longitude"})
