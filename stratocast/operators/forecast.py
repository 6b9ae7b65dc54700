"""Trend lines, gap filling and exponential-smoothing forecasts (FC1-FC6).

Everything runs per series key with built-in functions:

* FC6 trend: ``regr_slope`` / ``regr_intercept`` / ``regr_r2`` per key.
* FC4 gaps: each known period finds the next one with ``lead`` and emits
  the missing periods in between with ``explode(sequence(...))``, linearly
  interpolated: one pass, no join. A key's rows are its periods (years, or
  days at most), so a window per key is bounded by the calendar, not by the
  number of readings.
* FC1 / FC2 forecast: each key's periods (already aggregated, so one row per
  period; its length is the number of periods, not of readings) are folded
  with the SQL higher-order ``aggregate`` once per candidate model of a fixed
  grid of smoothing weights, all in the key's own row; the best candidate is
  the least by AIC (``array_min``). No join, no Python UDF.

Models (Hyndman, Koehler, Snyder & Grose 2002; error-correction form):

* ``simple`` (A,N,N): level only.
* ``holt`` (A,A,N): level and trend.
* ``seasonal`` (A,N,A): level and m seasonal terms.
* ``holt_winters`` (A,A,A): level, trend and m seasonal terms.

Forecast: ``l_n + h·b_n + s``, s being the last term of the season of n + h.
Recursion: ``e = y_t - (l + b + s_t-m)``, ``l' = l + b + αe``,
``b' = b + αβe``, ``s_t = s_t-m + γe``; b and s stay 0 in the models without.
An error of j periods before moves the forecast by
``c_j = α(1 + βj) + γ·[j is a multiple of m]``, so the forecast's variance is
``σ²(1 + c_1² + ... + c_h-1²)``.

Start values without season: ``l_1 = y_1``, ``b_1 = y_2 - y_1``, and the errors
start at t = 2. With season: ``b_0`` is the change from the first cycle's mean to
the second's, by period; ``l_0`` lies on the line with this slope through the
first cycle's mean, and the seasonal terms are the first cycle's distances from
the line. ``σ² = SSE / n``; ``AIC = n·ln(max(σ², 1e-12)) + 2k`` with k = 2
(simple), 4 (holt), m + 2 (seasonal) or m + 4 (holt_winters). A model with
``k >= n`` is not considered, and one with a season only if the series has three
whole cycles; ties go to the smaller k, then the smaller weights.

The season's length is given (12 for months, 4 for quarters, 7 for days), none,
or found in each series: the least lag whose differences go together nearly as
well as those of the best lag, and at least half as well as with themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratocast.functions.scalar import number_format
from stratocast.schemas import FORECAST_INDICATOR_ORDER

# Smoothing-weight grid: 0.05, 0.10, ..., 0.95 (alpha) and 0.05, 0.15, ..., 0.95 (beta)
ALPHAS = tuple(round(0.05 * i, 2) for i in range(1, 20))
BETAS = tuple(round(0.05 + 0.1 * i, 2) for i in range(0, 10))
# ... and of the seasonal models
GAMMAS = tuple(round(0.05 + 0.2 * i, 2) for i in range(0, 5))
SEASONAL_ALPHAS = SEASONAL_BETAS = GAMMAS
#: Periods of a season by the series' level; a year has none.
SEASONS = {"year": None, "quarter": 4, "month": 12, "day": 7, "hour": 24}
AUTO = "auto"
CYCLES = 3  # whole cycles that a seasonal model needs
LONGEST = 60  # season looked for
ALIKE, NEARLY = 0.5, 0.05  # what a season's lag must reach, and may miss of the best
Z95 = 1.959963984540054
_VAR_FLOOR = 1e-12
MODEL_COLUMNS = (
    "model", "alpha", "beta", "gamma", "season", "n_params", "n_points", "last_t", "level", "trend", "pattern", "sigma2", "aic",
)


# FC6 -------------------------------------------------------------------------
def trend_lines(series: DataFrame, keys: Sequence[str], t: str, y: str) -> DataFrame:
    """Least-squares line ``y = intercept + slope·t`` per key, with R².

    Slope and R² are rounded to 6 decimals and the intercept (the line at
    t = 0, far from yearly data) to 2: ``regr_*`` merge partial co-moments in
    task order, so digits beyond these vary from run to run."""
    tc, yc = F.col(t).cast("double"), F.col(y).cast("double")
    return series.groupBy(*keys).agg(
        F.count(yc).alias("n"),
        F.round(F.regr_slope(yc, tc), 6).alias("slope"),
        F.round(F.regr_intercept(yc, tc), 2).alias("intercept"),
        F.round(F.regr_r2(yc, tc), 6).alias("r2"),
    )


# FC4 -------------------------------------------------------------------------
def fill_missing(series: DataFrame, keys: Sequence[str], t: str, y: str, method: str = "interpolate") -> DataFrame:
    """Add the missing integer periods between each key's first and last
    known value.

    One pass, no join: each known point learns the next known point with
    ``lead`` and emits itself plus the periods up to that point with
    ``explode(sequence(...))``, interpolating on the way. ``method``:
    ``"interpolate"`` (linear between neighbours), ``"zero"`` or ``"null"``.
    Output: keys, ``t``, ``y`` and ``filled`` (true for added periods).
    A period that a key has twice is an error.
    """
    if method not in ("interpolate", "zero", "null"):
        raise ValueError(f"unknown fill method {method!r}")
    yc = F.col(y).cast("double")
    known = series.select(*keys, F.col(t), yc.alias("_y")).where(F.col("_y").isNotNull())
    w = Window.partitionBy(*keys).orderBy(F.col(t))
    spans = known.select(
        *keys,
        F.col(t).alias("_t0"),
        F.col("_y").alias("_y0"),
        F.lead(F.col(t)).over(w).alias("_t1"),
        F.lead(F.col("_y")).over(w).alias("_y1"),
    )
    twice = F.raise_error(F.concat(F.lit("period given twice: "), F.col("_t0").cast("string"))).cast(series.schema[t].dataType)
    last = F.coalesce(F.when(F.col("_t1") == F.col("_t0"), twice).otherwise(F.col("_t1") - F.lit(1)), F.col("_t0"))
    rows = spans.select("*", F.explode(F.sequence(F.col("_t0"), last)).alias(t))
    own = F.col(t) == F.col("_t0")
    if method == "zero":
        added = F.lit(0.0)
    elif method == "null":
        added = F.lit(None).cast("double")
    else:
        added = F.col("_y0") + (F.col("_y1") - F.col("_y0")) * (F.col(t) - F.col("_t0")) / (F.col("_t1") - F.col("_t0"))
    return rows.select(*keys, F.col(t), F.when(own, F.col("_y0")).otherwise(added).alias(y), (~own).alias("filled"))


# FC5 -------------------------------------------------------------------------
def drop_last(series: DataFrame, keys: Sequence[str], t: str, n: int) -> DataFrame:
    """Ignore each key's last ``n`` periods (last period per key from an
    aggregate, joined back)."""
    if n <= 0:
        return series
    last = series.groupBy(*keys).agg(F.max(t).alias("_last"))
    return series.join(last, list(keys)).where(F.col(t) <= F.col("_last") - F.lit(n)).drop("_last")


# FC1 / FC2 -------------------------------------------------------------------
def _grid(season: Column) -> Column:
    """The candidate models as one generated array (built on the executors
    from the rule above, not as hundreds of literals)."""

    def steps(count: int, first: float, by: float, of):
        return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: of(F.round(F.lit(first) + i * F.lit(by), 2)))

    def model(name: str, alpha, beta, gamma, k) -> Column:
        parts = {"model": F.lit(name), "alpha": alpha, "beta": beta, "gamma": gamma, "k": k.cast("int")}
        return F.struct(*[c.alias(n) for n, c in parts.items()])

    none = F.lit(0.0)
    few, many = (len(GAMMAS), 0.05, 0.2), (len(ALPHAS), 0.05, 0.05)
    simple = steps(*many, lambda a: model("simple", a, none, none, F.lit(2)))
    holt = F.flatten(steps(*many, lambda a: steps(len(BETAS), 0.05, 0.1, lambda b: model("holt", a, b, none, F.lit(4)))))
    seasonal = F.flatten(steps(*many, lambda a: steps(*few, lambda g: model("seasonal", a, none, g, season + 2))))
    both = F.flatten(
        F.flatten(steps(*few, lambda a: steps(*few, lambda b: steps(*few, lambda g: model("holt_winters", a, b, g, season + 4)))))
    )
    return F.when(season.isNull(), F.concat(simple, holt)).otherwise(F.concat(simple, holt, seasonal, both))


def _y(points: Column, i: Column) -> Column:
    """y of the i-th point, from 0."""
    return F.get(points, i)["y"]


def season_length(points: Column, n: Column) -> Column:
    """The length of the season of ``points`` (array of struct(t, y)), null if none shows."""
    steps = F.transform(F.sequence(F.lit(1), n - 1), lambda i: _y(points, i) - _y(points, i - 1))
    total = F.aggregate(steps, F.lit(0.0), lambda acc, d: acc + d * d)

    def likeness(lag: Column) -> Column:
        pairs = F.transform(F.sequence(lag, n - 2), lambda i: F.get(steps, i) * F.get(steps, i - lag))
        mean = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + p) / F.size(pairs)
        return F.struct(lag.alias("lag"), (mean / (total / (n - 1))).alias("r"))

    lags = F.transform(F.sequence(F.lit(2), F.least(F.floor(n / CYCLES).cast("int"), F.lit(LONGEST))), likeness)
    best = F.array_max(F.transform(lags, lambda x: x["r"]))
    fit = F.filter(lags, lambda x: (x["r"] >= best - F.lit(NEARLY)) & (x["r"] >= F.lit(ALIKE)))
    return F.when((n >= 2 * CYCLES) & (total > 0), F.array_min(F.transform(fit, lambda x: x["lag"])))


def _fold(points: Column, g: Column, season: Column) -> Column:
    """Run the smoothing recursion of the model ``g`` over ``points`` (array of
    struct(t, y))."""
    trended = g["model"].isin("holt", "holt_winters")
    seasonal = g["model"].isin("seasonal", "holt_winters")
    m = F.when(seasonal, season).otherwise(1)
    y1 = _y(points, F.lit(0))
    mean = lambda first: F.aggregate(F.slice(points, first, m), F.lit(0.0), lambda acc, p: acc + p["y"]) / m
    # the seasonal start values; other models never evaluate them
    slope = F.when(trended, (mean(m + 1) - mean(F.lit(1))) / m).otherwise(0.0)
    level = mean(F.lit(1)) - slope * (m + 1) / 2
    terms = F.transform(F.sequence(F.lit(1), m), lambda j: _y(points, j - 1) - (level + slope * j))
    init = F.struct(
        F.when(seasonal, level).otherwise(y1).alias("l"),
        F.when(seasonal, slope).when(trended, F.coalesce(_y(points, F.lit(1)), y1) - y1).otherwise(0.0).alias("b"),
        F.when(seasonal, terms).otherwise(F.array(F.lit(0.0))).alias("s"),
        F.lit(0.0).alias("sse"),
        F.lit(0).alias("i"),
    )

    def step(x: Column, p: Column) -> Column:
        first = (x["i"] == 0) & ~seasonal
        at = x["i"] % m
        f = x["l"] + x["b"]
        e = p["y"] - (f + F.get(x["s"], at))
        moved = F.transform(x["s"], lambda v, j: F.when(j == at, v + g["gamma"] * e).otherwise(v))
        return F.struct(
            F.when(first, x["l"]).otherwise(f + g["alpha"] * e).alias("l"),
            F.when(first, x["b"]).otherwise(x["b"] + g["alpha"] * g["beta"] * e).alias("b"),
            F.when(seasonal, moved).otherwise(x["s"]).alias("s"),
            F.when(first, x["sse"]).otherwise(x["sse"] + e * e).alias("sse"),
            (x["i"] + 1).alias("i"),
        )

    return F.aggregate(points, init, step)


def fit_models(series: DataFrame, keys: Sequence[str], t: str, y: str, season: int | str | None = None) -> DataFrame:
    """Best model per key: keys and ``MODEL_COLUMNS``; season is null and
    pattern one 0 in a model without season, pattern[i % season] being the term
    of the i-th point from 0 on. ``season``: periods of a season, "auto" to find
    it in each series, None for models without.

    Every candidate is folded over the key's points in the key's own row and
    the best is the smallest of an array, so the points move once."""
    taken = set(keys) & set(MODEL_COLUMNS)
    if taken:
        raise ValueError(f"key columns named like a model's: {sorted(taken)}")
    if season is not None and season != AUTO and not (isinstance(season, int) and season >= 2):
        raise ValueError(f"season {season!r}: two periods at least, {AUTO!r} or None")
    point = F.struct(F.col(t).cast("long").alias("t"), F.col(y).cast("double").alias("y"))
    pts = series.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("_fc_points")).where(F.size("_fc_points") > 0)
    points, n = F.col("_fc_points"), F.size("_fc_points")
    none = F.lit(None).cast("int")
    length = none if season is None else season_length(points, n) if season == AUTO else F.when(n >= CYCLES * season, F.lit(season))
    pts = pts.withColumn("_fc_season", length.cast("int"))
    m = F.col("_fc_season")
    grid = F.filter(_grid(m), lambda g: (g["k"] < n) | (g["model"] == "simple"))

    def fitted(g: Column) -> Column:
        return F.struct(g.alias("g"), _fold(points, g, m).alias("s"))

    def scored(f: Column) -> Column:
        g, s = f["g"], f["s"]
        sigma2 = s["sse"] / n
        aic = F.round(n * F.log(F.greatest(sigma2, F.lit(_VAR_FLOOR))) + F.lit(2) * g["k"], 9)
        return F.struct(
            aic.alias("aic"),
            g["k"].alias("n_params"),
            g["alpha"].alias("alpha"),
            g["beta"].alias("beta"),
            g["gamma"].alias("gamma"),
            g["model"].alias("model"),
            s["l"].alias("level"),
            s["b"].alias("trend"),
            s["s"].alias("pattern"),
            sigma2.alias("sigma2"),
        )

    best = pts.select(
        *keys,
        n.alias("_fc_n"),
        F.element_at(points, -1)["t"].alias("_fc_last"),
        m,
        F.array_min(F.transform(F.transform(grid, fitted), scored)).alias("_fc_best"),
    )
    b = F.col("_fc_best")
    values = {
        "n_points": F.col("_fc_n"),
        "last_t": F.col("_fc_last"),
        "season": F.when(b["model"].isin("seasonal", "holt_winters"), m),
    }
    return best.select(*keys, *[values.get(c, b[c]).alias(c) for c in MODEL_COLUMNS])


def forecast(
    series: DataFrame,
    keys: Sequence[str],
    t: str,
    y: str,
    horizon: int = 3,
    ignore_last: int = 0,
    fill: str | None = "interpolate",
    season: int | str | None = AUTO,
) -> DataFrame:
    """Estimates for the next ``horizon`` periods per key with a 95 % band:
    keys, ``t``, ``y`` (estimate), ``lower``, ``upper``, model, alpha, beta,
    gamma, season. Values are rounded to 6 decimals. ``season`` as in
    ``fit_models``.

    The last ``ignore_last`` periods are dropped (FC5), then missing periods
    are filled with ``fill`` (FC4: "interpolate", "zero", or None to fit the
    known points only) before the models are fitted."""
    base = drop_last(series, keys, t, ignore_last)
    if fill is not None:
        base = fill_missing(base, keys, t, y, fill).drop("filled")
    m = fit_models(base, keys, t, y, season)
    h = F.col("_fc_h")
    a, b, g, cycle = F.col("alpha"), F.col("beta"), F.col("gamma"), F.coalesce("season", F.lit(1))
    # what an error of j periods before adds to the estimate
    weights = F.transform(F.sequence(F.lit(0), h - 1), lambda j: a * (1 + b * j) + F.when(j % cycle == 0, g).otherwise(0.0))
    moved = F.aggregate(F.slice(weights, 2, h), F.lit(0.0), lambda acc, c: acc + c * c)
    var = F.col("sigma2") * (F.lit(1.0) + moved)
    est = F.col("level") + h * F.col("trend") + F.get("pattern", (F.col("n_points") + h - 1) % cycle)
    half = F.lit(Z95) * F.sqrt(var)
    return m.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_fc_h")).select(
        *keys,
        (F.col("last_t") + F.col("_fc_h")).alias(t),
        F.round(est, 6).alias(y),
        F.round(est - half, 6).alias("lower"),
        F.round(est + half, 6).alias("upper"),
        "model",
        "alpha",
        "beta",
        "gamma",
        "season",
    )


def forecast_with_actuals(
    series: DataFrame,
    keys: Sequence[str],
    t: str,
    y: str,
    horizon: int = 3,
    ignore_last: int = 0,
    fill: str | None = "interpolate",
    season: int | str | None = AUTO,
) -> DataFrame:
    """FC3: actual rows and estimate rows in one frame, with the indicator
    ("Actual" / "Estimate"), its manual order (T5) and the value as
    ``#,##0.0`` text (P11). Actual rows are the
    series as given; filled periods only feed the model."""
    actual = series.select(
        *keys,
        F.col(t).cast("long").alias(t),
        F.col(y).cast("double").alias(y),
        F.lit(None).cast("double").alias("lower"),
        F.lit(None).cast("double").alias("upper"),
        F.lit("Actual").alias("indicator"),
    )
    est = forecast(series, keys, t, y, horizon, ignore_last, fill, season).select(
        *keys, F.col(t).cast("long").alias(t), y, "lower", "upper", F.lit("Estimate").alias("indicator")
    )
    order = F.array_position(F.array(*[F.lit(v) for v in FORECAST_INDICATOR_ORDER]), F.col("indicator"))
    return (
        actual.unionByName(est)
        .withColumn("indicator_order", order.cast("long"))
        .withColumn("value_text", number_format(F.col(y), 1))  # P11: #,##0.0
    )
