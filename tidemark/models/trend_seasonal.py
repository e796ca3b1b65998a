"""M5-M7: additive trend + seasonality model per symbol.

Piecewise-linear trend with changepoints at row quantiles of the first 80 % of the training rows,
Fourier weekly (order 3) and yearly (order 10) terms: the maximum a posteriori form of the
additive model of Taylor & Letham (2018), with Laplace priors on the changes of slope, normal
ones on level, slope and seasonality, and a half-normal one on the noise. The design matrix
is built with Spark column expressions and X'X summed distributively; only the solve over
53 coefficients runs in Python, exactly (``laplace_map``).

Forecast bands are quantiles of simulated futures: slopes change after the training span as
often as they could inside it and by as much as they did, with noise on top. Draws are seeded by symbol
and day, so any partitioning gives the same band.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.models.solve import SOLUTION, fit_least_squares, solve_gram, unpacked
from tidemark.operators.dataset import TRAIN_DEN, TRAIN_NUM, chronological_split
from tidemark.operators.evaluate import align_actual_predicted, metrics_of, regression_metrics

# Fixed values of the reference's model parameters.
CHANGEPOINT_PRIOR_SCALE = 0.05
SEASONALITY_PRIOR_SCALE = 10.0
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
WEEKLY_ORDER, WEEKLY_PERIOD = 3, 7.0
YEARLY_ORDER, YEARLY_PERIOD = 10, 365.25
INTERVAL_Z = 1.2815515655446004  # 80 % two-sided band
BAND = [0.5 * (1 + math.erf(z / math.sqrt(2))) for z in (-INTERVAL_Z, INTERVAL_Z)]
TREND_PRIOR_SCALE = 5.0  # of level and slope
NOISE_PRIOR_SCALE = 0.5
NOISE_SCALE = 0.05  # assumed observation noise of the ridge form
SAMPLES = 1000
SEED = 20240102
FAR = 1e9  # a changepoint that never comes, where a series is too short for all of them

N_TREND = 2 + N_CHANGEPOINTS
N_WEEKLY = 2 * WEEKLY_ORDER
N_YEARLY = 2 * YEARLY_ORDER
K = N_TREND + N_WEEKLY + N_YEARLY


def penalties() -> list[float]:
    s2 = NOISE_SCALE ** 2
    return ([1e-9, 1e-9] + [s2 / CHANGEPOINT_PRIOR_SCALE ** 2] * N_CHANGEPOINTS
            + [s2 / SEASONALITY_PRIOR_SCALE ** 2] * (N_WEEKLY + N_YEARLY))


def design(date: Column, t0: Column, span: Column, knots: Column) -> Column:
    """Design row: [1, t, (t-c_j)+ …, weekly sin/cos …, yearly sin/cos …]."""
    d = F.unix_date(date).cast("double")
    t = (d - t0) / span
    parts = [F.lit(1.0), t] + [F.greatest(t - F.element_at(knots, j + 1), F.lit(0.0)) for j in range(N_CHANGEPOINTS)]
    for order, period in ((WEEKLY_ORDER, WEEKLY_PERIOD), (YEARLY_ORDER, YEARLY_PERIOD)):
        for k in range(1, order + 1):
            ang = d * F.lit(2.0 * math.pi * k / period)
            parts += [F.sin(ang), F.cos(ang)]
    return F.array(*parts)


def design_rows(day: np.ndarray, t0: float, span: float, knots: np.ndarray) -> np.ndarray:
    """``design`` of many days."""
    t = (day - t0) / span
    angles = day[:, None] * np.array([2.0 * math.pi * k / period for order, period in (
        (WEEKLY_ORDER, WEEKLY_PERIOD), (YEARLY_ORDER, YEARLY_PERIOD)) for k in range(1, order + 1)])
    out = np.empty((len(day), K))
    out[:, 0], out[:, 1], out[:, 2:N_TREND] = 1.0, t, np.maximum(t[:, None] - knots, 0.0)
    out[:, N_TREND::2], out[:, N_TREND + 1::2] = np.sin(angles), np.cos(angles)
    return out


def ts_dataset(bars: DataFrame) -> DataFrame:
    """(symbol, ds, y, split) plus per-symbol scaling from the train rows:
    ``t0``/``span`` (days), ``y_scale`` = max |y| and the changepoints ``knots`` (scaled times)."""
    s = chronological_split(bars.where(F.col("close").isNotNull())
                            .select("symbol", F.col("date").alias("ds"), F.col("close").alias("y")), "ds")
    w = Window.partitionBy("symbol")
    tr = F.col("split") == "train"
    d = F.unix_date("ds").cast("double")
    s = (s.withColumn("t0", F.min(F.when(tr, d)).over(w))
         .withColumn("span", F.greatest(F.max(F.when(tr, d)).over(w) - F.col("t0"), F.lit(1.0)))
         .withColumn("y_scale", F.max(F.when(tr, F.abs("y"))).over(w)))
    # knots are the times of N_CHANGEPOINTS rows spread over the first rows, the very first left out
    rows = F.floor(F.count(F.when(tr, 1)).over(w) * F.lit(int(CHANGEPOINT_RANGE * 100)) / 100).cast("int")
    s = s.withColumn("_last", F.greatest(rows - 1, F.lit(0)))
    s = s.withColumn("_knots", F.least(F.lit(N_CHANGEPOINTS), F.col("_last")))
    place = F.transform(F.sequence(F.lit(1), F.lit(N_CHANGEPOINTS)), lambda j: F.when(
        j <= F.col("_knots"), F.bround(j * F.col("_last") / F.col("_knots"))).otherwise(F.lit(-1)).cast("int"))
    here = F.when(tr & F.array_contains(place, F.col("rn") - 1), (d - F.col("t0")) / F.col("span"))
    s = s.withColumn("_here", here).withColumn("knots", F.sort_array(F.collect_list("_here").over(w)))
    s = s.withColumn("knots", F.slice(F.concat("knots", F.array_repeat(F.lit(FAR), N_CHANGEPOINTS)), 1, N_CHANGEPOINTS))
    return s.drop("_last", "_knots", "_here").withColumn("x", design(F.col("ds"), F.col("t0"), F.col("span"), F.col("knots")))


def l1_solve(g: np.ndarray, c: np.ndarray, weight: float, start: np.ndarray) -> np.ndarray:
    """min over b of b'gb/2 - c'b + weight * sum |b|, exactly, for a positive definite g.

    Feature-sign search (Lee et al., "Efficient sparse coding algorithms", 2006): the signs of the
    non-zero coefficients are guessed, the quadratic for these signs is solved, and the step is cut
    at the best point where a sign would change; a zero coefficient joins where its slope exceeds the weight."""
    b, sign = start.copy(), np.sign(start)
    slack = 1e-9 * max(weight, np.abs(c).max(), 1e-300)

    def value(x):
        return 0.5 * x @ g @ x - c @ x + weight * np.abs(x).sum()

    for _ in range(50 * len(b) + 50):
        slope = g @ b - c
        live = b != 0
        if not live.any() or np.abs(slope + weight * sign)[live].max() <= slack:
            idle = np.where(live, 0.0, np.abs(slope))
            j = int(idle.argmax())
            if idle[j] <= weight + slack:
                break
            sign[j] = -np.sign(slope[j])
            live = live.copy()
            live[j] = True
        at = np.flatnonzero(live)
        goal = np.zeros_like(b)
        goal[at] = np.linalg.solve(g[np.ix_(at, at)], c[at] - weight * sign[at])
        turn = goal - b
        with np.errstate(divide="ignore", invalid="ignore"):
            cut = np.where(turn != 0, -b / turn, np.inf)
        stops = [goal]
        for f in cut[(cut > 0) & (cut < 1) & live]:
            x = b + f * turn
            x[np.abs(cut - f) <= 1e-12] = 0.0
            stops.append(x)
        best = min(stops, key=value)
        if value(best) >= value(b) - 1e-15 * abs(value(b)) and np.allclose(best, b, rtol=1e-12, atol=0):
            break
        b = best
        sign = np.where(b != 0, np.sign(b), 0.0)
    return b


def laplace_map(a: np.ndarray, b: np.ndarray, yy: float, n: int) -> tuple[np.ndarray, float]:
    """Coefficients and noise of the posterior mode from X'X, X'y and y'y.

    For a given noise the coefficients without a Laplace prior are solved for (a Schur complement
    leaves the changes of slope alone), the changes by ``l1_solve``; for given coefficients the noise
    is the root of its own equation. Both are repeated until they stand."""
    change = np.arange(2, N_TREND)
    rest = np.r_[0, 1, np.arange(N_TREND, K)]
    prior = np.r_[[TREND_PRIOR_SCALE] * 2, [SEASONALITY_PRIOR_SCALE] * (N_WEEKLY + N_YEARLY)]
    moves = change[np.diag(a)[change] > 1e-12 * max(a[1, 1], 1e-300)]  # a change after the last row does not show
    beta, s2 = np.zeros(K), max(yy / n, 1e-12)
    for _ in range(200):
        free = a[np.ix_(rest, rest)] + np.diag(s2 / prior**2)
        cross = a[np.ix_(rest, moves)]
        solved = np.linalg.solve(free, np.c_[cross, b[rest]])
        g = a[np.ix_(moves, moves)] - cross.T @ solved[:, :-1]
        g = (g + g.T) / 2 + 1e-12 * max(np.trace(g), 1e-300) * np.eye(len(moves))
        delta = l1_solve(g, b[moves] - cross.T @ solved[:, -1], s2 / CHANGEPOINT_PRIOR_SCALE, beta[moves])
        new = np.zeros(K)
        new[moves], new[rest] = delta, solved[:, -1] - solved[:, :-1] @ delta
        rss = max(yy - 2 * new @ b + new @ a @ new, 0.0)
        v = 1 / NOISE_PRIOR_SCALE**2  # n log s + rss / 2 s^2 + v s^2 / 2 at its least
        s2_new = max((-n + math.sqrt(n * n + 4 * v * rss)) / (2 * v), 1e-12)
        done = abs(s2_new - s2) <= 1e-10 * s2
        beta, s2 = new, s2_new
        if done:
            break
    return beta, math.sqrt(s2)


def _fit_laplace(train: DataFrame) -> DataFrame:
    need = N_TREND + 2

    def one(_symbol, n, g):
        if n < need:
            return n, None, None, f"insufficient rows: {n} < {need}"
        a, b, yy = unpacked(g, K)
        coef, sigma = laplace_map(a, b, yy, n)
        return n, coef.tolist(), sigma, None

    return solve_gram(train.select("symbol", "x", (F.col("y") / F.col("y_scale")).alias("y")), one, SOLUTION)


def fit_trend_seasonal(ds: DataFrame, prior: str = "laplace") -> DataFrame:
    """M5: ``prior`` on the changes of slope: laplace (the model's own) or normal (a ridge regression)."""
    train = ds.where((F.col("split") == "train") & (F.col("y_scale") > 0))
    if prior == "laplace":
        fit = _fit_laplace(train)
    elif prior == "normal":
        fit = fit_least_squares(train.select("symbol", "x", (F.col("y") / F.col("y_scale")).alias("y")),
                                K, penalty=penalties(), min_rows=N_TREND + 2)
    else:
        raise ValueError(f"unknown prior: {prior}")
    scale = train.groupBy("symbol").agg(F.first("t0").alias("t0"), F.first("span").alias("span"), F.first("y_scale").alias("y_scale"),
                                        F.first("knots").alias("knots"), F.max("ds").alias("last_train_date"))
    return fit.join(scale, "symbol")


def train_series(day: np.ndarray, close: np.ndarray) -> dict | None:
    """``ts_dataset``, ``fit_trend_seasonal`` and ``evaluate_trend_seasonal`` of one symbol's closes in date order
    (NaN is null; a bar without a day is on no curve); None without a row to learn from."""
    kept = ~(np.isnan(close) | np.isnan(day))
    day, y = day[kept], close[kept]
    m = len(y) * TRAIN_NUM // TRAIN_DEN
    if not m or not np.abs(y[:m]).max() > 0:
        return None
    t0, span, y_scale = day[0], max(day[m - 1] - day[0], 1.0), np.abs(y[:m]).max()
    last = max(m * int(CHANGEPOINT_RANGE * 100) // 100 - 1, 0)
    n_knots = min(N_CHANGEPOINTS, last)
    place = np.rint(np.arange(1, n_knots + 1) * last / max(n_knots, 1)).astype(int)
    knots = np.r_[(day[place] - t0) / span, np.full(N_CHANGEPOINTS - n_knots, FAR)]
    state = {"t0": [t0], "span": [span], "y_scale": [y_scale], "sigma": [None], "knots": knots, "last_train_day": [day[m - 1]]}
    need = N_TREND + 2
    if m < need:
        return {"coef": None, "error": f"insufficient rows: {m} < {need}", "state": state, "metrics": None}
    x = design_rows(day, t0, span, knots)
    scaled = y[:m] / y_scale
    coef, sigma = laplace_map(x[:m].T @ x[:m], x[:m].T @ scaled, float(scaled @ scaled), m)
    return {"coef": coef, "error": None, "state": {**state, "sigma": [sigma]}, "metrics": metrics_of(y[m:], y_scale * (x[m:] @ coef))}


def components(x: Column, coef: Column, y_scale: Column) -> dict[str, Column]:
    def part(lo, hi):
        return F.aggregate(F.zip_with(F.slice(x, lo + 1, hi - lo), F.slice(coef, lo + 1, hi - lo),
                                      lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) * y_scale
    trend = part(0, N_TREND)
    weekly = part(N_TREND, N_TREND + N_WEEKLY)
    yearly = part(N_TREND + N_WEEKLY, K)
    return {"trend": trend, "weekly": weekly, "yearly": yearly}


def point_forecast(fit: DataFrame, dates: DataFrame, *keep: str) -> DataFrame:
    """M7: yhat and components for ``dates(symbol, ds, …keep)`` given the fits, with what a band needs."""
    j = dates.join(fit.where(F.col("error").isNull()), "symbol")
    comp = components(design(F.col("ds"), F.col("t0"), F.col("span"), F.col("knots")), F.col("coef"), F.col("y_scale"))
    return j.select("symbol", "ds", *keep, (comp["trend"] + comp["weekly"] + comp["yearly"]).alias("yhat"),
                    *[comp[c].alias(c) for c in ("trend", "weekly", "yearly")], "t0", "span", "y_scale", "sigma", "coef", "knots")


@lru_cache(256)
def _future_changes(key: int, part: int, rate: float, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Changes of slope in the scaled time (part, part + 1] of every sample: sample, time, size."""
    rng = np.random.default_rng([SEED, key, part])
    n = rng.poisson(rate, SAMPLES)
    return np.repeat(np.arange(SAMPLES), n), part + rng.random(int(n.sum())), rng.laplace(0.0, scale, int(n.sum()))


def day_deviations(symbol: str, days: np.ndarray, t: np.ndarray, sigma: float, changes: np.ndarray) -> np.ndarray:
    """Deviations of SAMPLES simulated values from the forecast of each day, on the scaled series: a row a day.

    t: the days' scaled times, in order; changes: the fitted changes of slope; the training span is the scaled time 0..1."""
    key = zlib.crc32(symbol.encode("utf-8", "surrogatepass"))
    out = np.array([np.random.default_rng([SEED, key, 1 << 31, int(day) & 0xFFFFFFFF]).normal(0.0, sigma, SAMPLES) for day in days])
    scale = float(np.abs(changes).mean()) + 1e-8 if len(changes) else 0.0
    for part in range(1, max(math.ceil(t[-1]), 1)) if scale else ():
        who, at, size = _future_changes(key, part, float(len(changes)), scale)
        soon = np.flatnonzero(at < t[-1])
        soon = soon[np.argsort(at[soon])] if len(t) > 1 else soon
        who, at, size = who[soon], at[soon], size[soon]
        # a change adds size * (t - part) - size * (at - part) to the days after it: both factors summed from day to day
        slope, start, done = np.zeros(SAMPLES), np.zeros(SAMPLES), 0
        for i, n in enumerate(np.searchsorted(at, t) if len(t) > 1 else [len(at)]):
            if n > done:
                slope += np.bincount(who[done:n], size[done:n], minlength=SAMPLES)
                start += np.bincount(who[done:n], size[done:n] * (at[done:n] - part), minlength=SAMPLES)
                done = n
            out[i] += slope * (t[i] - part) - start
    return out


def sampled_deviations(symbol: str, day: int, t: float, sigma: float, changes: np.ndarray) -> np.ndarray:
    """``day_deviations`` of one day."""
    return day_deviations(symbol, np.array([day]), np.array([t]), sigma, changes)[0]


def day_forecasts(symbol: str, days: np.ndarray, coef: np.ndarray, t0: float, span: float, y_scale: float, sigma: float,
                  knots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """yhat and the ends of the sampled band of ``forecast_frame`` for some days of one symbol."""
    yhat = y_scale * (design_rows(days, t0, span, knots) @ coef)
    out = day_deviations(symbol, days, (days - t0) / span, sigma, coef[2:N_TREND][knots < FAR])
    low, high = y_scale * np.quantile(out, BAND, axis=1, overwrite_input=True)
    return yhat, yhat + low, yhat + high


def _with_sampled_band(points: DataFrame) -> DataFrame:
    def run(batches):
        for pdf in batches:
            ends = np.empty((len(pdf), 2))
            for i, r in enumerate(pdf.itertuples(index=False)):
                knots = np.asarray(r.knots, float)
                changes = np.asarray(r.coef, float)[2:N_TREND][knots < FAR]
                ends[i] = r.y_scale * np.quantile(sampled_deviations(
                    r.symbol, int(r.day), (r.day - r.t0) / r.span, r.sigma, changes), BAND)
            yield pdf[["symbol", "ds", "yhat"]].assign(
                yhat_lower=pdf["yhat"] + ends[:, 0], yhat_upper=pdf["yhat"] + ends[:, 1],
                **{c: pdf[c] for c in ("trend", "weekly", "yearly")})

    return points.withColumn("day", F.unix_date("ds")).mapInPandas(
        run, "symbol string, ds date, yhat double, yhat_lower double, yhat_upper double, trend double, weekly double, yearly double")


def forecast_frame(fit: DataFrame, dates: DataFrame, band: str = "sampled") -> DataFrame:
    """M7: yhat, 80 % band and components for ``dates(symbol, ds)`` given the fits.

    ``band``: sampled (simulated futures) or analytic (the noise alone)."""
    points = point_forecast(fit, dates)
    if band == "sampled":
        return _with_sampled_band(points)
    if band != "analytic":
        raise ValueError(f"unknown band: {band}")
    half = F.lit(INTERVAL_Z) * F.col("sigma") * F.col("y_scale")
    return points.select("symbol", "ds", "yhat", (F.col("yhat") - half).alias("yhat_lower"), (F.col("yhat") + half).alias("yhat_upper"),
                         "trend", "weekly", "yearly")


def future_frame(fit: DataFrame, h: int | Column, include_history: DataFrame | None = None) -> DataFrame:
    """M6: h calendar days after each symbol's last train date (plus history dates)."""
    hc = F.lit(h) if isinstance(h, int) else h
    fut = fit.select("symbol", F.explode(F.sequence(F.date_add("last_train_date", 1),
                                                    F.date_add("last_train_date", hc))).alias("ds"))
    if include_history is not None:
        fut = include_history.select("symbol", "ds").unionByName(fut)
    return fut


def evaluate_trend_seasonal(ds: DataFrame, fit: DataFrame, align: str = "date") -> DataFrame:
    """Score the test split.

    ``align="date"`` forecasts the test dates themselves (correct alignment).
    ``align="position"`` reproduces the reference: forecast the ``n_test``
    calendar days after the last train date and pair them with the test rows
    by position (J1 positional join on ``(symbol, step)``).
    """
    test = ds.where(F.col("split") == "test").select("symbol", "ds", "y", "rn", "n")
    if align == "date":
        # each test row forecasts its own date
        return regression_metrics(point_forecast(fit, test, "y").select("symbol", "y", "yhat"), ("symbol",))
    if align != "position":
        raise ValueError(f"unknown alignment: {align}")
    test = test.withColumn("step", (F.col("rn") - F.floor(F.col("n") * 4 / 5)).cast("int"))
    h = test.groupBy("symbol").agg(F.max("step").alias("h"))
    days = fit.join(h, "symbol").select(
        "symbol", F.posexplode(F.sequence(F.date_add("last_train_date", 1),
                                          F.date_add("last_train_date", F.col("h")))).alias("pos", "ds"))
    fc = point_forecast(fit, days.select("symbol", "ds")).join(days, ["symbol", "ds"]).select(
        "symbol", (F.col("pos") + 1).alias("step"), "yhat")
    return regression_metrics(align_actual_predicted(test.select("symbol", "step", "y"), fc, ("symbol", "step")), ("symbol",))
