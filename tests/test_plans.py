"""Physical-plan properties the design relies on at scale.

Each test builds a query and checks its executed plan: partial aggregation
before every shuffle, no sort for the first-direction aggregate, a partial
WindowGroupLimit below the shuffle for the window form, filters and column
pruning reaching the Parquet scan, top-N as TakeOrderedAndProject, and no
forced broadcast.
"""

import re

import __spark_entry__ as E
from stratocast.operators import daily as D
from stratocast.plans import views as V
from stratocast.plans import weather as W
from stratocast.sources import standin as S

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    """The final (AQE) plan of ``df``'s own execution (sf0.001: small)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]  # the string also holds the initial plan


def test_daily_aggregate_is_partial_before_shuffle(spark):
    plan = _plan(D.daily_temperature(S.event_readings(spark, SF, "temperature")))
    assert "partial_sum" in plan and "partial_min" in plan
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_sum")  # partial below the exchange


def test_first_direction_is_a_hash_aggregate(spark):
    plan = _plan(D.daily_direction(S.event_degrees(spark, SF)))
    assert "HashAggregate" in plan
    assert "SortAggregate" not in plan and "Window" not in plan and " Sort " not in plan


def test_window_form_limits_before_shuffle(spark):
    plan = _plan(D.daily_direction(S.event_degrees(spark, SF), method="window"))
    assert plan.count("WindowGroupLimit") == 2  # partial (map side) and final


def test_one_day_filter_reaches_parquet(spark):
    df = D.daily_temperature(S.event_readings(spark, SF, "temperature"), day="2024-01-15")
    plan = _plan(df)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in pushed and "LessThan(ts,2024-01-16T00:00)" in pushed
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert read == "ts:timestamp_ntz,event_type:string,value:double"  # only the needed columns


def test_month_filter_pushes_through_the_fact_aggregate(spark):
    plan = _plan(V.average_value(W.fact_direction(spark, SF), "Temperature", 199708, "AMERICA"))
    assert "GreaterThanOrEqual(o_orderdate,1997-08-01T00:00)" in plan


def test_top_n_is_take_ordered(spark):
    plan = _plan(E.queries()["top_cities"](spark, SF))
    assert "TakeOrderedAndProject(limit=10" in plan


def test_sides_are_broadcast_by_their_bytes_only(spark):
    """No hint forces a broadcast: without the thresholds nothing is, and the
    rows are the same."""
    want = {f: sorted(map(repr, W.fact_range(spark, SF, form=f).collect())) for f in ("keyed", "stacked", "join")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for form, rows in want.items():
            df = W.fact_range(spark, SF, form=form)
            assert "Broadcast" not in _plan(df), form
            assert sorted(map(repr, df.collect())) == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_stacked_fact_has_one_aggregate_shuffle(spark):
    plan = _plan(W.fact_direction(spark, SF, form="stacked"))
    assert plan.count("Exchange hashpartitioning") == 1


def test_keyed_fact_shuffles_partials_then_days(spark):
    plan = _plan(W.fact_direction(spark, SF, form="keyed"))
    assert plan.count("Exchange hashpartitioning") == 2  # per-order partials, then (date, city)
    assert "partial_sum" in plan and plan.count("BroadcastHashJoin [o_custkey") == 1  # orders ⋈ customer once


def test_join_form_reuses_the_aggregate_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(W.fact_direction(spark, SF, form="join"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") >= 4
    # the daily aggregates shuffle on (date, city) once each; the joins on
    # (city, date) add no exchange of their own
    assert plan.count("Exchange hashpartitioning(_groupingexpression") == 5
    assert not re.search(r"Exchange hashpartitioning\((date|city#\d+, date)", plan)  # city alone: the dimension
