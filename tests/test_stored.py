"""Kept profiles (S10), dense ids of stored tables (K1) and stored facts."""

import datetime as dt
import os
import random

import __spark_entry__ as E
from pyspark.sql import functions as F

from stratocast.operators import keys as KEYS
from stratocast.sources import sinks as SK

SF = "/root/testdata/sf0.001"
D0 = dt.date(2020, 1, 1)


def test_sketched_profile_is_near_the_exact_one(spark, scratch_dir):
    """Distinct counts within four standard errors (1.6 %) of the exact ones,
    whatever the number of sketches merged and after a refresh."""
    rows = 60_000
    df = spark.range(rows).select(
        (F.col("id") % 7).alias("part"),
        F.col("id").alias("all"),
        (F.col("id") * 37 % 20_011).cast("double").alias("some"),
        F.when(F.col("id") % 3 == 0, (F.col("id") % 100).cast("string")).alias("few"),
        F.lit(None).cast("date").alias("none"),
    )
    path = os.path.join(scratch_dir, "profile")
    SK.refresh_profile(df, path, "part")
    SK.refresh_profile(df.where("part in (2, 3)"), path, "part")
    exact = {r.column_name: r for r in SK.profile(df.drop("part"), exact=True).collect()}
    got = {r.column_name: r for r in SK.stored_profile(spark, path, "part").collect()}
    assert got.keys() == exact.keys()
    for name, e in exact.items():
        r = got[name]
        assert (r.data_type, r.null_count, r.row_count) == (e.data_type, e.null_count, e.row_count)
        assert abs(r.distinct_count - e.distinct_count) <= 0.016 * e.distinct_count
    assert got["few"].distinct_count == 100 and got["none"].distinct_count == 0


def test_refreshed_values_replace_their_sketches(spark, scratch_dir):
    path = os.path.join(scratch_dir, "profile")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, None)], "part int, v string")
    SK.refresh_profile(df, path, "part")
    SK.refresh_profile(spark.createDataFrame([(2, "a")], df.schema), path, "part")
    r = SK.stored_profile(spark, path, "part").first()
    assert (r.distinct_count, r.null_count, r.row_count) == (2, 0, 3)


def test_sketches_need_no_expand(spark):
    fact = E.queries()["fact_direction"](spark, SF).withColumn("year", F.year("date"))
    sketches = SK.profile_sketches(fact, "year")
    assert "Expand" not in sketches._jdf.queryExecution().executedPlan().toString()


def test_dense_ids_after_reruns(spark, scratch_dir):
    rng = random.Random(1)
    path = os.path.join(scratch_dir, "t")
    table = {(D0 + dt.timedelta(days=i), f"C{j}"): i * j for i in range(9) for j in rng.sample(range(20), 12)}

    def store(days, replaced=()):
        rows = [(d, c, v) for (d, c), v in table.items() if d in days]
        df = spark.createDataFrame(rows, "date date, city string, v long").repartition(4)
        KEYS.store_ranked(df, path, ["city"], replaced=replaced)

    def check():
        want = [(i, d, c, table[d, c]) for i, (d, c) in enumerate(sorted(table), 1)]
        assert sorted((r.id, r.date, r.city, r.v) for r in KEYS.read_dense(spark, path).collect()) == want

    store({d for d, _ in table})
    check()
    other = {p: os.stat(p).st_mtime_ns for p in _files(path) if "date=2020-01-05" not in p}
    del table[dt.date(2020, 1, 5), next(c for d, c in table if d == dt.date(2020, 1, 5))]
    table[dt.date(2020, 1, 5), "A"] = -1
    table[dt.date(2020, 1, 5), "B"] = -2
    store({dt.date(2020, 1, 5)})
    check()
    # no other day's files were written
    assert {p: os.stat(p).st_mtime_ns for p in _files(path) if "date=2020-01-05" not in p} == other
    for d, c in list(table):
        if d == D0:
            del table[d, c]
    table[dt.date(2020, 2, 1), "Z"] = 5
    store({dt.date(2020, 2, 1)}, replaced=[D0])
    check()


def _files(path):
    return [os.path.join(a, f) for a, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "/_" not in a]


def test_stored_facts_join_without_exchange(spark):
    """Between the daily tables; only the city dimension may move."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = E.queries()["fact_range_stored"](spark, SF)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        tables = plan.count("Bucketed: true")
        assert tables == 4 and plan.count("SortMergeJoin") >= 4
        for line in plan.splitlines():
            assert "Exchange hashpartitioning(city" not in line or "date" not in line
        rows = sorted(map(repr, fact.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == sorted(map(repr, E.queries()["fact_range"](spark, SF).select(*fact.columns).collect()))
