"""Trend, gap filling and forecasts (FC1-FC6), including a brute-force check
of the Spark fold against a plain-Python run of the same recursion."""

import math
import random

import pytest

from stratocast.operators import forecast as FC


def _series(spark, rows):
    return spark.createDataFrame(rows, "city string, year long, value double")


def _brute_best(ys):
    """Same candidate grid, recursion and AIC rule, in plain Python."""
    n = len(ys)
    best = None
    cands = [("simple", a, 0.0, 2) for a in FC.ALPHAS] + [("holt", a, b, 4) for a in FC.ALPHAS for b in FC.BETAS]
    for model, a, b, k in cands:
        if k >= n and model != "simple":
            continue
        level, trend = ys[0], (ys[1] - ys[0] if (model == "holt" and n > 1) else 0.0)
        sse = 0.0
        for y in ys[1:]:
            f = level + trend
            e = y - f
            level, trend = f + a * e, trend + a * b * e
            sse += e * e
        sigma2 = sse / n
        aic = round(n * math.log(max(sigma2, 1e-12)) + 2 * k, 9)
        key = (aic, k, a, b)
        if best is None or key < best[0]:
            best = (key, model, a, b, level, trend, sigma2)
    return best


def test_straight_line_is_continued(spark):
    rows = [("L", 2013 + i, 10.0 + 2.0 * i) for i in range(5)]
    out = FC.forecast(_series(spark, rows), ["city"], "year", "value", horizon=2).orderBy("year").collect()
    assert [r.year for r in out] == [2018, 2019]
    assert out[0].value == pytest.approx(20.0) and out[1].value == pytest.approx(22.0)
    assert out[0].model == "holt"


def test_constant_series_has_zero_band(spark):
    rows = [("K", 2013 + i, 5.0) for i in range(5)]
    out = FC.forecast(_series(spark, rows), ["city"], "year", "value", horizon=3).collect()
    assert all(r.value == pytest.approx(5.0) and r.lower == pytest.approx(5.0) and r.upper == pytest.approx(5.0) for r in out)
    assert {r.model for r in out} == {"simple"}


def test_fold_matches_brute_force(spark):
    data = {
        "A": [50.1, 53.4, 49.8, 55.2, 57.0],
        "B": [12.0, 11.0, 15.5, 14.0, 13.25, 16.0, 18.5],
        "C": [3.0, 3.0],
    }
    rows = [(k, 2000 + i, y) for k, ys in data.items() for i, y in enumerate(ys)]
    fits = {r.city: r for r in FC.fit_models(_series(spark, rows), ["city"], "year", "value").collect()}
    for key, ys in data.items():
        _, model, a, b, level, trend, sigma2 = _brute_best(ys)
        got = fits[key]
        assert (got.model, got.alpha, got.beta) == (model, pytest.approx(a), pytest.approx(b))
        assert got.level == pytest.approx(level) and got.trend == pytest.approx(trend)
        assert got.sigma2 == pytest.approx(sigma2, abs=1e-12)


def test_band_grows_with_horizon(spark):
    rows = [("A", 2000 + i, y) for i, y in enumerate([50.1, 53.4, 49.8, 55.2, 57.0])]
    out = FC.forecast(_series(spark, rows), ["city"], "year", "value", horizon=3).orderBy("year").collect()
    widths = [r.upper - r.lower for r in out]
    assert widths[0] <= widths[1] <= widths[2]


def test_actual_and_estimate_rows(spark):
    rows = [("A", 2000 + i, float(i)) for i in range(5)]
    out = FC.forecast_with_actuals(_series(spark, rows), ["city"], "year", "value", horizon=2).collect()
    assert sorted((r.indicator, r.indicator_order) for r in out).count(("Actual", 1)) == 5
    assert sum(1 for r in out if r.indicator == "Estimate" and r.indicator_order == 2) == 2


def test_fill_missing(spark):
    rows = [("A", 2013, 10.0), ("A", 2015, 14.0), ("A", 2016, 15.0)]
    s = _series(spark, rows)
    interp = {r.year: (r.value, r.filled) for r in FC.fill_missing(s, ["city"], "year", "value").collect()}
    assert interp == {2013: (10.0, False), 2014: (12.0, True), 2015: (14.0, False), 2016: (15.0, False)}
    zero = {r.year: r.value for r in FC.fill_missing(s, ["city"], "year", "value", "zero").collect()}
    assert zero[2014] == 0.0


def test_drop_last_and_trend(spark):
    rows = [("A", 2000 + i, 3.0 + 2.0 * i) for i in range(5)]
    s = _series(spark, rows)
    assert FC.drop_last(s, ["city"], "year", 2).count() == 3
    t = FC.trend_lines(s, ["city"], "year", "value").first()
    assert (t.n, t.slope, t.r2) == (5, 2.0, 1.0)
    assert t.intercept == pytest.approx(3.0 - 2.0 * 2000)


def test_missing_year_is_filled_before_fitting(spark):
    rows = [("L", y, 10.0 + 2.0 * (y - 2013)) for y in (2013, 2014, 2016, 2017)]  # 2015 missing
    s = _series(spark, rows)
    out = FC.forecast(s, ["city"], "year", "value", horizon=1).first()
    assert (out.year, out.model) == (2018, "holt") and out.value == pytest.approx(20.0)
    raw = FC.forecast(s, ["city"], "year", "value", horizon=1, fill=None).first()
    assert raw.value != pytest.approx(20.0)  # fitting the 4 known points only bends the line


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ys=st.lists(st.integers(min_value=-500, max_value=500).map(lambda v: v / 4.0), min_size=2, max_size=8))
def test_fold_matches_brute_force_on_random_series(spark, ys):
    rows = [("K", 2000 + i, y) for i, y in enumerate(ys)]
    got = FC.fit_models(_series(spark, rows), ["city"], "year", "value").first()
    _, model, a, b, level, trend, sigma2 = _brute_best(ys)
    assert (got.model, got.alpha, got.beta) == (model, pytest.approx(a), pytest.approx(b))
    assert got.level == pytest.approx(level, abs=1e-9) and got.trend == pytest.approx(trend, abs=1e-9)


# -- models with a season ---------------------------------------------------------
def _candidates(m, n):
    few = FC.GAMMAS
    out = [("simple", a, 0.0, 0.0, 2) for a in FC.ALPHAS]
    out += [("holt", a, b, 0.0, 4) for a in FC.ALPHAS for b in FC.BETAS]
    if m and n >= 3 * m:
        out += [("seasonal", a, 0.0, g, m + 2) for a in FC.ALPHAS for g in few]
        out += [("holt_winters", a, b, g, m + 4) for a in few for b in few for g in few]
    return [c for c in out if c[4] < n or c[0] == "simple"]


def _run(ys, m, model, a, b, g):
    """Level, trend, the next m seasonal terms and the squared errors' sum, in
    Holt and Winters' component form."""
    if model in ("seasonal", "holt_winters"):
        one, two = sum(ys[:m]) / m, sum(ys[m : 2 * m]) / m
        trend = (two - one) / m if model == "holt_winters" else 0.0
        level = one - trend * (m + 1) / 2
        season, left = [y - level - trend * (j + 1) for j, y in enumerate(ys[:m])], ys
    else:
        level, trend, season, left = ys[0], ys[1] - ys[0] if model == "holt" and len(ys) > 1 else 0.0, [0.0], ys[1:]
    sse = 0.0
    for y in left:
        sse += (y - level - trend - season[0]) ** 2
        new = a * (y - season[0]) + (1 - a) * (level + trend)
        term = g * (y - level - trend) + (1 - g) * season[0]
        trend, level = b * (new - level) + (1 - b) * trend, new
        season = [*season[1:], term]
    return level, trend, season, sse


def _estimates(state, horizon):
    level, trend, season, _ = state
    return [level + h * trend + season[(h - 1) % len(season)] for h in range(1, horizon + 1)]


def _best(ys, m):
    n = len(ys)
    score = lambda c: (round(n * math.log(max(_run(ys, m, *c[:4])[3] / n, 1e-12)) + 2 * c[4], 9), c[4], *c[1:4])
    return min(_candidates(m, n), key=score)


def _seasonal_series(kind):
    rng = random.Random(kind)
    wave = [12 * math.sin(math.pi * j / 6) for j in range(12)]
    if kind == "months":
        return [50 + wave[i % 12] + rng.gauss(0, 1) for i in range(60)], 12
    if kind == "rising months":
        return [50 + 0.9 * i + wave[i % 12] + rng.gauss(0, 0.5) for i in range(48)], 12
    if kind == "quarters":
        return [[3.0, 8.0, 5.0, 1.0][i % 4] + 0.2 * i + rng.gauss(0, 0.1) for i in range(20)], 4
    if kind == "changing":
        return [[3.0, 8.0, 5.0, 1.0][i % 4] * (1 + i / 20) + rng.gauss(0, 0.2) for i in range(24)], 4
    return [rng.gauss(0, 3) for _ in range(36)], 12


@pytest.mark.parametrize("kind", ["months", "rising months", "quarters", "changing", "noise"])
def test_seasonal_fit_and_estimates_match_brute_force(spark, kind):
    ys, m = _seasonal_series(kind)
    model, a, b, g, k = _best(ys, m)
    state = _run(ys, m, model, a, b, g)
    s = _series(spark, [("K", 100 + i, y) for i, y in enumerate(ys)])
    got = FC.fit_models(s, ["city"], "year", "value", season=m).first()
    assert (got.model, got.alpha, got.beta, got.gamma, got.n_params) == (model, a, b, g, k)
    assert got.season == (m if model in ("seasonal", "holt_winters") else None) and got.sigma2 == pytest.approx(state[3] / len(ys))
    out = FC.forecast(s, ["city"], "year", "value", horizon=2 * m + 1, season=m).orderBy("year").collect()
    assert [r.value for r in out] == pytest.approx(_estimates(state, 2 * m + 1), abs=2e-6)
    if kind != "noise":
        assert got.season == m


@pytest.mark.parametrize("kind", ["months", "rising months", "quarters", "changing"])
def test_band_is_the_variance_of_future_errors(spark, kind):
    """The estimates' variance from what a single error changes in them, found
    by running the recursion on with and without it."""
    ys, m = _seasonal_series(kind)
    best = _best(ys, m)
    horizon = 2 * m + 2
    state = _run(ys, m, *best[:4])

    def ahead(shock):
        level, trend, season = state[0], state[1], list(state[2])
        out = []
        for h in range(horizon):
            f = level + trend + season[0]
            e = 1.0 if shock and h == 0 else 0.0
            out.append(f + e)
            level, trend = level + trend + best[1] * e, trend + best[1] * best[2] * e
            season = [*season[1:], season[0] + best[3] * e]
        return out

    psi = [x - y for x, y in zip(ahead(True), ahead(False), strict=True)]  # 1, c_1, c_2, ...
    sigma2 = state[3] / len(ys)
    want = [FC.Z95 * math.sqrt(sigma2 * sum(c * c for c in psi[:h])) for h in range(1, horizon + 1)]
    s = _series(spark, [("K", i, y) for i, y in enumerate(ys)])
    out = FC.forecast(s, ["city"], "year", "value", horizon=horizon, season=m).orderBy("year").collect()
    assert [(r.upper - r.lower) / 2 for r in out] == pytest.approx(want, abs=2e-6)


def test_holt_band_is_the_variance_of_future_errors(spark):
    ys = [50.1, 53.4, 49.8, 58.2, 61.0, 66.5, 64.0, 72.0]
    s = _series(spark, [("K", i, y) for i, y in enumerate(ys)])
    fit = FC.fit_models(s, ["city"], "year", "value").first()
    assert fit.model == "holt" and fit.trend
    out = FC.forecast(s, ["city"], "year", "value", horizon=4, season=None).orderBy("year").collect()
    for h, r in enumerate(out, 1):
        moved = sum((fit.alpha * (1 + fit.beta * j)) ** 2 for j in range(1, h))
        assert (r.upper - r.lower) / 2 == pytest.approx(FC.Z95 * math.sqrt(fit.sigma2 * (1 + moved)), abs=2e-6)


def test_a_season_is_found_and_continued(spark):
    rng = random.Random(8)
    data = {
        "two": [1.0, 9.0] * 4,
        "three": [1.0, 5.0, 9.0] * 4,
        "twelve": [20 + 9 * math.sin(math.pi * i / 6) + rng.gauss(0, 0.5) for i in range(60)],
        "line": [2.0 * i for i in range(20)],
        "flat": [4.0] * 20,
        "noise": [rng.gauss(0, 1) for _ in range(40)],
        "short": [1.0, 9.0, 1.0, 9.0],
        "one": [3.0],
    }
    s = _series(spark, [(k, i, y) for k, ys in data.items() for i, y in enumerate(ys)])
    fits = {r.city: r for r in FC.fit_models(s, ["city"], "year", "value", season=FC.AUTO).collect()}
    assert {k: r.season for k, r in fits.items()} == {"two": 2, "three": 3, "twelve": 12, "line": None, "flat": None, "noise": None, "short": None, "one": None}
    assert fits["line"].model == "holt" and fits["flat"].model == fits["one"].model == "simple"
    out = FC.forecast(s, ["city"], "year", "value", horizon=4).orderBy("year").collect()
    by_key = {k: [r.value for r in out if r.city == k] for k in data}
    assert by_key["two"] == pytest.approx([1, 9, 1, 9]) and by_key["three"] == pytest.approx([1, 5, 9, 1])
    assert by_key["one"] == [3.0] * 4
    none = FC.fit_models(s, ["city"], "year", "value").collect()
    assert {r.season for r in none} == {None} and {tuple(r.pattern) for r in none} == {(0.0,)}


@pytest.mark.parametrize("season", [1, 0, -12, 2.5, "monthly"])
def test_odd_seasons_are_errors(spark, season):
    with pytest.raises(ValueError, match="two periods"):
        FC.fit_models(_series(spark, [("K", 1, 1.0)]), ["city"], "year", "value", season=season)
