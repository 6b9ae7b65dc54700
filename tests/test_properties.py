"""Property tests: daily roll-ups and the first direction of the day against a
plain-Python brute force, on generated readings where one city holds a large
share of the rows (the skewed case the plans must get right)."""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratocast.operators import daily as D
from stratocast.schemas import COMPASS_OTHERWISE, COMPASS_SECTORS

T0 = dt.datetime(2017, 10, 31)


def _round_half_up(x: float) -> float:
    snapped = Decimal(repr(x)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
    return float(snapped.quantize(Decimal("1"), rounding=ROUND_HALF_UP))


def _compass(d):
    if d is None:
        return COMPASS_OTHERWISE
    for name, low, high in COMPASS_SECTORS:
        if low <= d <= high:
            return name
    return COMPASS_OTHERWISE


reading = st.tuples(
    st.integers(min_value=0, max_value=71),  # hour offset: three days
    st.sampled_from(["hot", "hot", "hot", "a", "b"]),  # "hot" takes ~60 % of rows
    st.integers(min_value=0, max_value=3600).map(lambda v: v / 10.0),  # one decimal, like the readings
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(reading, min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1])))
def test_daily_stats_match_brute_force(spark, rows):
    data = [(T0 + dt.timedelta(hours=h), c, v) for h, c, v in rows]
    df = spark.createDataFrame(data, "datetime timestamp_ntz, city string, pressure double").repartition(4)
    got = {(r.date, r.city): (r.pressure, r.min_pressure, r.max_pressure) for r in D.daily_pressure(df).collect()}
    groups = defaultdict(list)
    for ts, c, v in data:
        groups[(ts.date(), c)].append(v)
    want = {k: (_round_half_up(sum(vs) / len(vs)), _round_half_up(min(vs)), _round_half_up(max(vs))) for k, vs in groups.items()}
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(reading, min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1])))
def test_first_direction_matches_brute_force(spark, rows):
    data = [(T0 + dt.timedelta(hours=h), c, v) for h, c, v in rows]
    df = spark.createDataFrame(data, "datetime timestamp_ntz, city string, wind_direction double").repartition(4)
    want = {}
    for ts, c, v in sorted(data):
        want.setdefault((ts.date(), c), _compass(v))
    for method in ("aggregate", "window"):
        got = {(r.date, r.city): r.wind_direction for r in D.daily_direction(df, method=method).collect()}
        assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    series=st.dictionaries(
        st.sampled_from(["k1", "k2", "k3"]),
        st.dictionaries(st.integers(min_value=0, max_value=30), st.integers(min_value=-50, max_value=50), min_size=1, max_size=8),
        min_size=1,
    )
)
def test_fill_missing_matches_brute_force(spark, series):
    from stratocast.operators.forecast import fill_missing

    rows = [(k, t, float(v)) for k, pts in series.items() for t, v in pts.items()]
    df = spark.createDataFrame(rows, "key string, t long, y double").repartition(3)
    got = {(r.key, r.t): (r.y, r.filled) for r in fill_missing(df, ["key"], "t", "y").collect()}
    want = {}
    for k, pts in series.items():
        ts = sorted(pts)
        for a, b in zip(ts, ts[1:] + [None]):
            want[(k, a)] = (float(pts[a]), False)
            if b is not None:
                for t in range(a + 1, b):
                    want[(k, t)] = (pts[a] + (pts[b] - pts[a]) * (t - a) / (b - a), True)
    assert got.keys() == want.keys()
    for key, (v, filled) in want.items():
        assert got[key][1] == filled and abs(got[key][0] - v) < 1e-9


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(["c1", "c2", "c3", "c4", "c5"]),
            st.sampled_from([dt.date(2014, 7, 1), dt.date(2014, 8, 1), dt.date(2014, 8, 2)]),
            st.integers(min_value=0, max_value=9),
        ),
        min_size=1,
        max_size=30,
        unique_by=lambda r: (r[0], r[1]),
    ),
    n=st.integers(min_value=1, max_value=4),
    scope=st.sampled_from(["global", "filtered"]),
    end=st.sampled_from(["top", "bottom"]),
)
def test_top_members_match_brute_force(spark, rows, n, scope, end):
    from stratocast.operators import filters as FL
    from stratocast.operators.topn import top_members
    from stratocast.schemas import measure

    df = spark.createDataFrame([(c, d, float(v)) for c, d, v in rows], "city string, date date, temperature double")
    aug = FL.month_year_matches(201408)
    got = [(r.city, r.value) for r in top_members(df, measure("temperature"), n, end, "average", "average", scope, aug).collect()]

    def avg_by_city(rs):
        acc = defaultdict(list)
        for c, _, v in rs:
            acc[c].append(v)
        return {c: sum(vs) / len(vs) for c, vs in acc.items()}

    in_aug = [r for r in rows if r[1].month == 8]
    ranking = avg_by_city(rows if scope == "global" else in_aug)
    order = sorted(ranking, key=lambda c: ((-ranking[c]) if end == "top" else ranking[c], c))
    members = set(order[:n])
    shown = avg_by_city([r for r in in_aug if r[0] in members])
    want = sorted(shown.items(), key=lambda cv: ((-cv[1]) if end == "top" else cv[1], cv[0]))
    assert got == want
