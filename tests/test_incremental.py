"""Ledger, day runs, reruns, late readings and the day-folder stream
(I1-I6, S4-S9, ST1-ST2), on temporary folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stratocast.plans import incremental as INC
from stratocast.sources import sinks as SK
from stratocast.streaming import day_folders as ST


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def _day_files(root, day, hours=(0, 1), late=None):
    d = day.isoformat()
    for attribute, base in [("temperature", 280.0), ("pressure", 1000.0), ("humidity", 50.0), ("wind_speed", 3.0), ("wind_direction", 100.0)]:
        lines = ["datetime,Boston,Miami"]
        for h in hours:
            lines.append(f"{d} {h:02d}:00:00,{base + h},{base + 10 + h}")
        if late:
            lines.append(f"{late} 05:00:00,{base + 100},")
        _write(os.path.join(root, f"input_{d}", attribute, "part-0.csv"), "\n".join(lines) + "\n")
    _write(os.path.join(root, f"input_{d}", "weather_description", "part-0.csv"), f"datetime,Boston,Miami\n{d} 00:00:00,clear,rain\n")


def _cities(root, day):
    _write(
        os.path.join(root, f"input_{day.isoformat()}", "city_attributes", "cities.csv"),
        "City,Country,Latitude,Longitude\nBoston,United States,42.36,-71.06\nMiami,United States,25.77,-80.19\n",
    )


def test_ledger_rules(spark, scratch_dir):
    ledger = os.path.join(scratch_dir, "ledger")
    assert INC.next_day(spark, ledger) == dt.date(2017, 10, 31)
    INC.append_ledger(spark, ledger, dt.date(2017, 11, 5))
    INC.append_ledger(spark, ledger, dt.date(2017, 11, 2))  # older than the previous entry
    assert INC.next_day(spark, ledger) == dt.date(2017, 11, 3)


def test_text_ledger(spark, scratch_dir):
    p = os.path.join(scratch_dir, "processing.db")
    assert INC.next_day_from_text(spark, p) == dt.date(2017, 10, 31)
    _write(p, "")
    assert INC.next_day_from_text(spark, p) == dt.date(2017, 10, 31)
    _write(p, "2017-11-05\n2017-11-02\n\n\n")
    assert INC.next_day_from_text(spark, p) == dt.date(2017, 11, 3)


def _snapshot(spark, layout, table):
    return sorted(map(tuple, spark.read.parquet(layout.aggregate(table)).orderBy("date", "city").collect()))


def test_run_days_rerun_and_late_reading(spark, scratch_dir):
    raw = os.path.join(scratch_dir, "raw")
    layout = INC.Layout(raw, os.path.join(scratch_dir, "wh"))
    d1, d2 = dt.date(2017, 10, 31), dt.date(2017, 11, 1)
    _cities(raw, d1)
    _day_files(raw, d1)
    _day_files(raw, d2, late=d1.isoformat())  # a reading for d1 arrives in d2's folder

    r1 = INC.run_day(spark, layout)
    assert r1["day"] == d1 and r1["touched"] == [d1]
    assert spark.read.parquet(layout.aggregate("cities")).count() == 2
    before = _snapshot(spark, layout, "daily_pressure")

    INC.run_day(spark, layout, day=d1)  # rerun: same tables
    assert _snapshot(spark, layout, "daily_pressure") == before

    r2 = INC.run_day(spark, layout)
    assert r2["day"] == d2 and r2["touched"] == [d1, d2]
    p = {(r.date, r.city): r for r in spark.read.parquet(layout.aggregate("daily_pressure")).collect()}
    # Boston on d1: 1000, 1001 and the late 1100 -> mean 1033.67 -> 1034, max 1100
    assert p[(d1, "Boston")].pressure == 1034.0 and p[(d1, "Boston")].max_pressure == 1100.0
    assert INC.next_day(spark, layout.ledger) == dt.date(2017, 11, 2)
    # full load == sum of daily loads: every staged reading counted once
    staged = spark.read.parquet(layout.staging("pressure"))
    assert staged.count() == 2 * 2 + 2 * 2 + 1
    directions = spark.read.parquet(layout.aggregate("wind_direction_daily_average"))
    assert directions.groupBy("date", "city").count().where(F.col("count") != 1).count() == 0
    served = INC.publish_with_ids(spark, layout, "daily_pressure", os.path.join(scratch_dir, "served", "daily_pressure"))
    assert served.columns[0] == "id"
    assert sorted(r.id for r in served.collect()) == [1, 2, 3, 4]
    first = served.orderBy("id").first()
    assert (first.date, first.city) == (d1, "Boston")
    cities = INC.publish_with_ids(spark, layout, "cities", os.path.join(scratch_dir, "served", "cities"))
    assert [r.city for r in cities.orderBy("id").collect()] == ["Boston", "Miami"]
    # facts maintained per day equal a full rebuild from the stored tables
    from stratocast.operators import facts as J

    agg = lambda t: spark.read.parquet(layout.aggregate(t))
    full = J.join_fact_direction(
        agg("cities"), agg("daily_temperature"), agg("daily_pressure"), agg("humidity_daily_average"),
        agg("wind_speed_daily_average"), agg("wind_direction_daily_average"), ("United States", "Canada"),
    )
    kept = agg("fact_direction").select(*full.columns)
    assert kept.count() == 4
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, full.collect()))
    assert agg("fact_range").count() == 4


def test_stop_date_guard(spark, scratch_dir):
    layout = INC.Layout(os.path.join(scratch_dir, "raw"), os.path.join(scratch_dir, "wh"))
    assert INC.run_day(spark, layout, day=dt.date(2017, 11, 30)) is None


def test_stream_of_day_folders(spark, scratch_dir):
    raw = os.path.join(scratch_dir, "raw")
    layout = INC.Layout(raw, os.path.join(scratch_dir, "wh"))
    ckpt = os.path.join(scratch_dir, "ckpt")
    d1, d2 = dt.date(2017, 10, 31), dt.date(2017, 11, 1)
    _day_files(raw, d1)
    attrs = ("temperature", "pressure", "wind_direction")
    first = ST.run_available(spark, layout, attributes=attrs, checkpoint=ckpt)
    assert [d for batch in first for d in batch] == [d1]
    _day_files(raw, d2, late=d1.isoformat())
    second = ST.run_available(spark, layout, attributes=attrs, checkpoint=ckpt)
    assert sorted(d for batch in second for d in batch) == [d1, d2]
    t = {(r.date, r.city): r.max_temperature for r in spark.read.parquet(layout.aggregate("daily_temperature")).collect()}
    assert t[(d1, "Boston")] == round((380.0 - 273.15) * 9 / 5 + 32)
    # nothing new: no batch
    assert ST.run_available(spark, layout, attributes=attrs, checkpoint=ckpt) == []


def test_sinks_snapshot_and_catalog(spark, scratch_dir):
    df = spark.createDataFrame([(dt.date(2017, 10, 31), "A", 1.0)], "date date, city string, pressure double")
    path = os.path.join(scratch_dir, "snap")
    SK.write_snapshot(df, path)
    SK.write_snapshot(df, path)
    assert spark.read.parquet(path).count() == 1
    SK.write_partitioned(df, os.path.join(scratch_dir, "part"))
    SK.write_partitioned(df, os.path.join(scratch_dir, "part"))
    assert spark.read.parquet(os.path.join(scratch_dir, "part")).count() == 1
    assert SK.table_name("data", "cities") == "data.cities"
    assert SK.table_name("data", "cities", "cat") == "cat.data.cities"


def test_create_tables_and_bucketed_join(spark, scratch_dir):
    made = SK.create_tables(spark, "wx_staging", SK.STAGING_DDL, os.path.join(scratch_dir, "db"), drop_existing=True)
    assert "wx_staging.temperature" in made
    cols = [c.name for c in spark.catalog.listColumns("temperature", "wx_staging")]
    assert cols[:3] == ["datetime", "city", "temperature"]
    assert SK.create_tables(spark, "wx_staging", SK.STAGING_DDL) == made  # idempotent

    rows = [(dt.date(2017, 10, 31) + dt.timedelta(days=i % 5), f"C{i % 7}", float(i)) for i in range(35)]
    a = spark.createDataFrame(rows, "date date, city string, pressure double")
    b = spark.createDataFrame(rows, "date date, city string, humidity double")
    SK.write_bucketed(a, "wx_staging.p_bucketed", 4, ["city", "date"])
    SK.write_bucketed(b, "wx_staging.h_bucketed", 4, ["city", "date"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the sort-merge path
    try:
        joined = spark.table("wx_staging.p_bucketed").join(spark.table("wx_staging.h_bucketed"), ["city", "date"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange hashpartitioning" not in plan  # co-bucketed: no shuffle on either side
        assert joined.count() == 35
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_read_table_paths_and_catalog(spark, scratch_dir):
    from stratocast.sources.tables import read_table

    df = spark.createDataFrame([(dt.date(2017, 10, 31), "A", 1.0)], "date date, city string, pressure double")
    path = os.path.join(scratch_dir, "t")
    df.write.parquet(path)
    assert read_table(spark, path).count() == 1
    spark.sql("CREATE DATABASE IF NOT EXISTS wx_read")
    df.write.mode("overwrite").saveAsTable("wx_read.t")
    assert read_table(spark, "wx_read.t").collect() == df.collect()


def test_stage_several_day_folders_in_one_job(spark, scratch_dir):
    raw = os.path.join(scratch_dir, "raw")
    layout = INC.Layout(raw, os.path.join(scratch_dir, "wh"))
    d1, d2 = dt.date(2017, 10, 31), dt.date(2017, 11, 1)
    _day_files(raw, d1)
    _day_files(raw, d2, late=d1.isoformat())
    with pytest.raises(FileNotFoundError):  # the last has no folder: nothing is staged
        INC.stage_folders(spark, layout, "pressure", [d1, d2, dt.date(2017, 11, 5)])
    assert sorted(INC.stage_folders(spark, layout, "pressure", [d1, d2])) == [d1, d2]
    staged = spark.read.parquet(layout.staging("pressure"))
    got = sorted((r.date, r.load_date, r.city) for r in staged.collect())
    assert got.count((d1, d2, "Boston")) == 1  # the late reading keeps its own folder day
    assert sum(1 for g in got if g[1] == d1) == 4 and sum(1 for g in got if g[1] == d2) == 5


def test_cli_commands(spark, scratch_dir):
    from stratocast import cli

    raw = os.path.join(scratch_dir, "raw")
    wh = os.path.join(scratch_dir, "wh")
    d1 = dt.date(2017, 10, 31)
    _cities(raw, d1)
    _day_files(raw, d1)
    out = cli.run(spark, "run-day", raw, wh)
    assert out["day"] == "2017-10-31" and out["touched"] == ["2017-10-31"]
    assert "daily_temperature" in out["tables"]
    assert cli.run(spark, "run-day", raw, wh, dt.date(2017, 11, 30)) == {"finished": True}
    streamed = cli.run(spark, "run-stream", raw, os.path.join(scratch_dir, "wh2"), checkpoint=os.path.join(scratch_dir, "ck"))
    assert streamed["days"] == ["2017-10-31"]


def test_all_attributes_are_staged_in_one_job(spark, scratch_dir, monkeypatch):
    raw = os.path.join(scratch_dir, "raw")
    layout = INC.Layout(raw, os.path.join(scratch_dir, "wh"))
    one_by_one = INC.Layout(raw, os.path.join(scratch_dir, "wh2"))
    d1, d2 = dt.date(2017, 10, 31), dt.date(2017, 11, 1)
    _day_files(raw, d1)
    _day_files(raw, d2, late=d1.isoformat())
    attributes = ["humidity", "pressure", "temperature", "weather_description", "wind_direction", "wind_speed"]
    written, write = [], INC.write_partitioned_multi
    monkeypatch.setattr(INC, "write_partitioned_multi", lambda df, path, by: (written.append((df, by)), write(df, path, by)))
    assert sorted(INC.stage_attributes(spark, layout, attributes, [d1, d2])) == [d1, d2]
    assert [by for _, by in written] == [["attribute", "date", "load_date", "part"]]
    # one scan of the lines and one of their headers, for one write
    assert written[0][0]._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    for a in attributes:
        INC.stage_folders(spark, one_by_one, a, [d1, d2])
        columns = ["datetime", "city", a, "date", "load_date"]
        both = [sorted(map(repr, spark.read.parquet(x.staging(a)).select(*columns).collect())) for x in (layout, one_by_one)]
        assert both[0] == both[1] and both[0]
    assert not os.path.exists(layout.staging("_beside")) or not os.listdir(layout.staging("_beside"))
    # a rerun of one day replaces its folders only
    _day_files(raw, d2, hours=(0,))
    assert sorted(INC.stage_attributes(spark, layout, ["pressure", "humidity"], [d2])) == [d1, d2]
    assert spark.read.parquet(layout.staging("pressure")).count() == 4 + 2
    assert spark.read.parquet(layout.staging("temperature")).count() == 4 + 5


def test_files_that_arrive_one_by_one_are_read_once(spark, scratch_dir, monkeypatch):
    raw = os.path.join(scratch_dir, "raw")
    layout = INC.Layout(raw, os.path.join(scratch_dir, "wh"))
    whole = INC.Layout(raw, os.path.join(scratch_dir, "wh2"))
    d1 = dt.date(2017, 10, 31)
    lines = 0
    for i in range(6):
        cities = ["Boston", "Miami"][:: 1 if i % 2 else -1]
        for attribute, base in (("pressure", 1000.0), ("temperature", 280.0)):
            text = [f"datetime,{cities[0]},{cities[1]}"] + [f"2017-10-31 {2 * i + h:02d}:00:00,{base + i},{base - i}" for h in range(2)]
            _write(os.path.join(raw, f"input_{d1}", attribute, f"part-{i}.csv"), "\n".join(text) + "\n")
            lines += len(text)
    read = []
    process = ST.process_batch

    def watched(spark, layout, batch):
        files = {r.file for r in batch.select("file").distinct().collect()}
        read.append(files)
        return process(spark, layout, batch)

    monkeypatch.setattr(ST, "process_batch", watched)
    attributes = ("temperature", "pressure")
    done = ST.run_available(spark, layout, attributes=attributes, checkpoint=os.path.join(scratch_dir, "ck"), max_files_per_trigger=5)
    assert done == [[d1]] * 3 and [len(r) for r in read] == [5, 5, 2]
    assert len(set().union(*read)) == 12  # each file in one batch
    INC.stage_attributes(spark, whole, attributes, [d1])
    INC.aggregate_days(spark, whole, [d1], attributes)
    for table in ("daily_temperature", "daily_pressure"):
        assert _snapshot(spark, layout, table) == _snapshot(spark, whole, table)
    parts = {os.path.basename(a) for a, _, _ in os.walk(layout.staging("pressure")) if os.path.basename(a).startswith("part=")}
    assert len(parts) == 6 and spark.read.parquet(layout.staging("pressure")).count() == 24
    # a batch that comes again replaces its files' rows; a batch run of the folder replaces all
    again = spark.read.text(os.path.join(raw, f"input_{d1}", "pressure")).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    assert process(spark, layout, again) == [d1]
    assert _snapshot(spark, layout, "daily_pressure") == _snapshot(spark, whole, "daily_pressure")
    assert spark.read.parquet(layout.staging("pressure")).count() == 24
    INC.stage_attributes(spark, layout, ["pressure"], [d1])
    assert spark.read.parquet(layout.staging("pressure")).count() == 24


def test_a_batch_reads_its_files_once(spark, scratch_dir):
    raw = os.path.join(scratch_dir, "raw")
    layout = INC.Layout(raw, os.path.join(scratch_dir, "wh"))
    d1 = dt.date(2017, 10, 31)
    _day_files(raw, d1, hours=range(5))
    progress = []

    def handle(batch, _):
        ST.process_batch(spark, layout, batch)

    q = (
        ST.arrivals(spark, raw, ("pressure", "temperature")).writeStream.foreachBatch(handle)
        .option("checkpointLocation", os.path.join(scratch_dir, "ck")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    progress = [p["numInputRows"] for p in q.recentProgress]
    assert sum(progress) == 2 * 6  # headers and hours of two files, whatever the batch does with them
