"""Replaced partitions, the ledger's commits and catalog tables: failures at
every point, and two writers at once."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from test_incremental import _cities, _day_files

from stratocast.plans import incremental as INC
from stratocast.sources import ledger as L
from stratocast.sources import publish as PUB
from stratocast.sources import sinks as SK

D1, D2, D3 = dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 3)


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "date date, city string, v long")


def _replace(spark, table, df, replaced=()):
    wanted = [f"date={d.isoformat()}" for d in replaced]
    return PUB.replace_partitions(spark, table, ["date"], lambda to: SK.write_partitioned(df, to), wanted)


def _read(df):
    return sorted((r.date, r.city, r.v) for r in df.select("date", "city", "v").collect())


@pytest.fixture
def table(spark, scratch_dir):
    path = os.path.join(scratch_dir, "table")
    _replace(spark, path, _rows(spark, (D1, "A", 1), (D2, "A", 2), (D3, "A", 3)))
    return path


OLD = [(D1, "A", 1), (D2, "A", 2), (D3, "A", 3)]
NEW = [(D1, "A", 10), (D1, "B", 11), (D3, "A", 3)]  # the second day has no rows any more


def _second(spark):
    return _rows(spark, (D1, "A", 10), (D1, "B", 11))


def test_partitions_are_replaced_and_emptied(spark, table):
    _replace(spark, table, _second(spark), [D1, D2])
    assert _read(spark.read.parquet(table)) == _read(PUB.read_current(spark, table)) == NEW
    third = _rows(spark, (D2, "C", 7))
    _replace(spark, table, third)
    assert _read(spark.read.parquet(table)) == sorted([*NEW, (D2, "C", 7)])
    # what the last write but one replaced is gone, what the last replaced is kept
    assert [p.getName() for p in PUB.glob(spark, f"{table}/_replaced/*")] == ["3".zfill(20)]


def test_a_failure_while_writing_leaves_the_old_rows(spark, table):
    def fails(to):
        SK.write_partitioned(_second(spark), to)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        PUB.replace_partitions(spark, table, ["date"], fails, ["date=2020-01-02"])
    assert _read(spark.read.parquet(table)) == _read(PUB.read_current(spark, table)) == OLD
    _replace(spark, table, _second(spark), [D1, D2])
    assert _read(spark.read.parquet(table)) == NEW


def test_a_failure_before_the_manifest_leaves_the_old_rows(spark, table, monkeypatch):
    monkeypatch.setattr(PUB, "put_if_absent", lambda *a: (_ for _ in ()).throw(OSError("no store")))
    with pytest.raises(OSError, match="no store"):
        _replace(spark, table, _second(spark), [D1, D2])
    assert _read(spark.read.parquet(table)) == _read(PUB.read_current(spark, table)) == OLD


@pytest.mark.parametrize("moves", range(4))
def test_a_failure_after_the_manifest_leaves_the_new_rows(spark, table, monkeypatch, moves):
    """Whatever the number of folders that had been moved, no partition is ever
    missing or doubled for ``read_current``; the next write finishes the move."""
    done, move = [], PUB.move

    def fails(*a):
        if len(done) >= moves:
            raise OSError("lost")
        done.append(1)
        move(*a)

    monkeypatch.setattr(PUB, "move", fails)
    try:
        _replace(spark, table, _second(spark), [D1, D2])
    except OSError:
        pass
    assert _read(PUB.read_current(spark, table)) == NEW
    monkeypatch.setattr(PUB, "move", move)
    PUB.recover(spark, table)
    assert _read(spark.read.parquet(table)) == _read(PUB.read_current(spark, table)) == NEW
    PUB.recover(spark, table)
    assert _read(spark.read.parquet(table)) == NEW


def test_recovery_by_several_at_once(spark, table, monkeypatch):
    apply = PUB._apply
    monkeypatch.setattr(PUB, "_apply", lambda *a: None)
    wanted = [f"date={d.isoformat()}" for d in (D1, D2)]
    writer = PUB.replace_partitions(spark, table, ["date"], lambda to: SK.write_partitioned(_second(spark), to), wanted)
    assert _read(spark.read.parquet(table)) == OLD and _read(PUB.read_current(spark, table)) == NEW
    monkeypatch.setattr(PUB, "_apply", apply)
    with ThreadPoolExecutor(4) as pool:
        for f in [pool.submit(apply, spark, table, writer) for _ in range(4)]:
            f.result()
    assert _read(spark.read.parquet(table)) == _read(PUB.read_current(spark, table)) == NEW


def test_one_of_many_makes_the_file(spark, scratch_dir):
    path = os.path.join(scratch_dir, "f", "1.json")

    def put(i):
        try:
            PUB.put_if_absent(spark, path, str(i))
            return i
        except PUB.Taken:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(put, range(16)) if i is not None]
    assert len(won) == 1 and PUB.read_text(spark, path) == str(won[0])
    assert os.listdir(os.path.dirname(path)) == ["1.json"] or {n for n in os.listdir(os.path.dirname(path)) if not n.endswith(".crc")} == {"1.json"}


# -- ledger -----------------------------------------------------------------------
def _entries(spark, path):
    return [(r.seq, r.date) for r in L.read_ledger(spark, path).orderBy("seq").collect()]


def test_of_two_runs_one_appends(spark, scratch_dir):
    path = os.path.join(scratch_dir, "ledger")
    seen = L.last_entry(spark, path)
    assert (seen.seq, seen.date, seen.commit) == (0, None, 0)
    L.append_ledger(spark, path, D1, D2, after=seen)
    with pytest.raises(PUB.Taken):
        L.append_ledger(spark, path, D1, after=seen)
    assert _entries(spark, path) == [(1, D1), (2, D2)]
    seen = L.last_entry(spark, path)

    def append(d):
        try:
            L.append_ledger(spark, path, d, after=seen)
            return 1
        except PUB.Taken:
            return 0

    with ThreadPoolExecutor(6) as pool:
        assert sum(pool.map(append, [D3] * 6)) == 1
    assert _entries(spark, path) == [(1, D1), (2, D2), (3, D3)]


def test_commits_are_folded(spark, scratch_dir, monkeypatch):
    monkeypatch.setattr(L, "COMPACT", 4)
    path = os.path.join(scratch_dir, "ledger")
    days = [D1 + dt.timedelta(days=i) for i in range(11)]
    stale = None
    for i, d in enumerate(days):
        if i == 2:
            stale = L.last_entry(spark, path)
        L.append_ledger(spark, path, d)
        assert _entries(spark, path) == list(enumerate(days[: i + 1], 1))
    assert len(L._numbers(spark, f"{path}/commits")) == 3 and L._numbers(spark, f"{path}/folded") == [8]
    with pytest.raises(PUB.Taken):  # its number was given and has been folded away
        L.append_ledger(spark, path, D1, after=stale)
    assert _entries(spark, path) == list(enumerate(days, 1)) and INC.next_day(spark, path) == days[-1] + dt.timedelta(days=1)


def test_a_ledger_of_parquet_files_goes_on(spark, scratch_dir):
    path = os.path.join(scratch_dir, "ledger")
    spark.createDataFrame([(1, D1), (2, D3)], L.LEDGER_SCHEMA).write.parquet(path)
    assert INC.next_day(spark, path) == D3 + dt.timedelta(days=1)
    L.append_ledger(spark, path, D2)
    assert _entries(spark, path) == [(1, D1), (2, D3), (3, D2)]


def test_two_runs_of_one_day(spark, scratch_dir, monkeypatch):
    """The second run's day has been appended by another one while it ran."""
    raw = os.path.join(scratch_dir, "raw")
    layout = INC.Layout(raw, os.path.join(scratch_dir, "wh"))
    day = dt.date(2017, 10, 31)
    _cities(raw, day)
    _day_files(raw, day)
    stage = INC.stage_attributes

    def slow(*a):
        monkeypatch.setattr(INC, "stage_attributes", stage)
        INC.run_day(spark, layout)
        return stage(*a)

    monkeypatch.setattr(INC, "stage_attributes", slow)
    with pytest.raises(PUB.Taken):
        INC.run_day(spark, layout)
    assert _entries(spark, layout.ledger) == [(1, day)]
    assert spark.read.parquet(layout.aggregate("daily_pressure")).count() == 2


# -- catalog ----------------------------------------------------------------------
def test_run_day_fills_catalog_tables(spark, scratch_dir):
    raw = os.path.join(scratch_dir, "raw")
    layout = INC.Layout(raw, os.path.join(scratch_dir, "wh"), database="wx_job", catalog="spark_catalog")
    d1, d2 = dt.date(2017, 10, 31), dt.date(2017, 11, 1)
    _cities(raw, d1)
    _day_files(raw, d1)
    _day_files(raw, d2, late=d1.isoformat())
    INC.run_day(spark, layout)
    first = {r.city: r.id for r in spark.table("wx_job.daily_pressure").collect()}
    INC.run_day(spark, layout)
    for table in INC.AGGREGATED.values():
        stored, named = spark.read.parquet(layout.aggregate(table)), spark.table(f"spark_catalog.wx_job.{table}")
        assert sorted(map(tuple, named.drop("id").select(*stored.columns).collect())) == sorted(map(tuple, stored.collect()))
        assert named.select("id").distinct().count() == named.count() == 4
    again = {r.city: r.id for r in spark.table("wx_job.daily_pressure").where(F.col("date") == d1).collect()}
    assert again == first and [f.name for f in spark.table("wx_job.daily_pressure").schema][-1] == "date"
    assert spark.table("wx_job_staging.pressure").count() == spark.read.parquet(layout.staging("pressure")).count() == 9
    assert [(r.id, r.City) for r in spark.table("wx_job.cities").orderBy("id").collect()] == [(1, "Boston"), (2, "Miami")]
    assert spark.table("wx_job_staging.city_attributes").count() == 2
    # the late reading goes, and so do a day's rows when its folder has none
    _day_files(raw, d2, hours=())
    INC.run_day(spark, layout, day=d2)
    assert {r.date for r in spark.table("wx_job.daily_pressure").collect()} == {d1}
    assert spark.catalog.tableExists("wx_job.daily_pressure") and "date=2017-10-31" in [
        r.partition for r in spark.sql("SHOW PARTITIONS wx_job.daily_pressure").collect()
    ]


def test_a_schema_that_differs_is_refused(spark, scratch_dir):
    SK.create_tables(spark, "wx_refuse", SK.AGGREGATE_DDL, os.path.join(scratch_dir, "db"))
    good = spark.sql("SELECT DATE'2020-01-01' AS date, 'A' AS city, 1D AS pressure, 1D AS min_pressure, 1D AS max_pressure, 5L AS id")
    SK.insert_days(good, "wx_refuse.daily_pressure", [D1])
    bad = good.withColumn("pressure", F.lit("1")).drop("id").withColumn("more", F.lit(1))
    with pytest.raises(ValueError, match="id is missing; more is not declared; pressure is string, declared double"):
        SK.insert_days(bad, "wx_refuse.daily_pressure", [D1])
    assert spark.table("wx_refuse.daily_pressure").count() == 1
    SK.insert_days(good.where("false"), "wx_refuse.daily_pressure", [D1])
    assert spark.table("wx_refuse.daily_pressure").count() == 0
