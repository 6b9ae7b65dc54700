"""The ledger of processed days (I1, I2) as a log of commits.

Each append is one file, ``commits/<number>.json``, with the rows ``(seq,
date)`` that it adds, and is made only if no such number is there yet. So of two
runs that saw the same last entry one appends, and the other is told by
``Taken``; a ``seq`` is never given twice. After ``COMPACT`` commits they are
folded into one file, ``folded/<number>.json``, that holds all rows up to this
number; a reader takes the last one and the commits after it.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratocast.sources.publish import Taken, delete, exists, glob, put_if_absent

LEDGER_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType(), False), T.StructField("date", T.DateType(), False)]
)
COMPACT = 64  # commits before they are folded


@dataclass(frozen=True)
class Entry:
    """The ledger's last row, with the number of the commit that has it."""

    seq: int
    date: _dt.date | None
    commit: int


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(p.getName().removesuffix(".json")) for p in glob(spark, f"{folder}/[0-9]*.json"))


def _files(spark: SparkSession, path: str) -> tuple[list[str], int, int]:
    """(files to read, last commit, commits after the last fold). At most
    COMPACT files and one, unless folding failed."""
    commits = _numbers(spark, f"{path}/commits")
    folded = max(_numbers(spark, f"{path}/folded"), default=0)
    after = [n for n in commits if n > folded]
    files = [f"{path}/folded/{folded:020d}.json"] if folded else []
    return files + [f"{path}/commits/{n:020d}.json" for n in after], max([folded, *after]), len(after)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Processed dates in processing order ``(seq, date)``; also of a ledger
    that was kept as Parquet files before."""
    files, _, _ = _files(spark, path)
    rows = spark.read.schema(LEDGER_SCHEMA).json(files) if files else spark.createDataFrame([], LEDGER_SCHEMA)
    if glob(spark, f"{path}/*.parquet"):
        rows = spark.read.schema(LEDGER_SCHEMA).parquet(path).union(rows)
    return rows


def last_entry(spark: SparkSession, path: str) -> Entry:
    """The row of the largest ``seq``; no date if there is none."""
    if not exists(spark, path):
        return Entry(0, None, 0)
    commit = _files(spark, path)[1]
    r = read_ledger(spark, path).agg(F.max("seq").alias("seq"), F.max_by("date", "seq").alias("date")).first()
    return Entry(r.seq or 0, r.date, commit)


def append_ledger(spark: SparkSession, path: str, *days: _dt.date, after: Entry | None = None) -> None:
    """Append ``days`` as the newest entries. With ``after``, the last entry that
    this run has seen, ``Taken`` is raised if another run has appended since."""
    last = after if after is not None else last_entry(spark, path)
    rows = "\n".join(json.dumps({"seq": last.seq + i, "date": d.isoformat()}) for i, d in enumerate(days, 1))
    commit = f"{path}/commits/{last.commit + 1:020d}.json"
    put_if_absent(spark, commit, rows)
    if last.commit < max(_numbers(spark, f"{path}/folded"), default=0):
        delete(spark, glob(spark, commit))  # the number had been given, and folded
        raise Taken(commit)
    if _files(spark, path)[2] >= COMPACT:
        fold(spark, path)


def fold(spark: SparkSession, path: str) -> None:
    """Fold all commits into one file, then drop them. Readers that listed them
    before may have to read again."""
    files, last, after = _files(spark, path)
    if not after:
        return
    # a row of a few bytes a processed day
    rows = spark.read.schema(LEDGER_SCHEMA).json(files).orderBy("seq").collect()
    text = "\n".join(json.dumps({"seq": r.seq, "date": r.date.isoformat()}) for r in rows)
    try:
        put_if_absent(spark, f"{path}/folded/{last:020d}.json", text)
    except Taken:
        return
    spent = glob(spark, f"{path}/folded/[0-9]*.json") + glob(spark, f"{path}/commits/[0-9]*.json")
    folded = f"/folded/{last:020d}.json"
    delete(spark, [p for p in spent if int(p.getName().removesuffix(".json")) <= last and not p.toString().endswith(folded)])
