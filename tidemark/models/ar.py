"""M3/M4: autoregression on first differences — ARIMA(p, d=1, 0) without constant.

Fit: exact Gaussian likelihood of the differences Δy_1..Δy_n of the train split (first 80 % of
each symbol's closes). It depends on the data through n, the lagged product sums
Σ Δy_t Δy_{t+k} and the first and last p differences alone, all of them Spark aggregates; what is
left per symbol is a Newton search over p coefficients (``exact_fit``). ``method="conditional"``
takes conditional least squares of Δy_t on Δy_{t-1..t-p} instead.

Forecast: short horizons run inside one ``aggregate`` over ``sequence(1, h)``, re-integrating
differences from the last train close; long ones by doubling blocks of the companion form
(``forecast_steps``).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.models.solve import fit_least_squares
from tidemark.operators.blocks import chunk_window, in_chunks, own_rows
from tidemark.operators.dataset import TRAIN_DEN, TRAIN_NUM, chronological_split
from tidemark.operators.evaluate import align_actual_predicted, metrics_of, regression_metrics

P_DEFAULT = 5


def ar_dataset(bars: DataFrame, p: int = P_DEFAULT, block_rows: int | None = None) -> DataFrame:
    """Rows ``(symbol, date, close, rn, n, split, dy, x=[Δy_{t-1}..Δy_{t-p}])``.

    Differences and lags are taken inside the train split only (test closes are
    the forecast targets), so the train block never sees test values. ``block_rows``
    cuts long series into blocks (see ``blocks``), with the same rows as a result."""
    if block_rows is not None:
        rows = in_chunks(chronological_split(bars.where(F.col("close").isNotNull()).select("symbol", "date", "close"), blocked=True)
                         .withColumn("_rn", F.col("rn")), block_rows, before=p + 1)
        w = chunk_window()

        def same_split(c, k):  # the value k rows back, if that row is of the same split
            return F.when(F.lag("split", k).over(w) == F.col("split"), F.lag(c, k).over(w))

        rows = rows.withColumn("dy", F.col("close") - same_split("close", 1))
        return own_rows(rows.withColumn("x", F.array(*[same_split("dy", i) for i in range(1, p + 1)])), "_rn")
    s = chronological_split(bars.where(F.col("close").isNotNull()).select("symbol", "date", "close"))
    w = Window.partitionBy("symbol", "split").orderBy("rn")
    dy = F.col("close") - F.lag("close", 1).over(w)
    s = s.withColumn("dy", dy)
    lags = [F.lag("dy", i).over(w) for i in range(1, p + 1)]
    return s.withColumn("x", F.array(*lags))


def product_matrices(lagged: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """D of the exact quadratic form, a matrix a series: D[i, j] is the sum of w_t w_{t+j-i} over the pairs
    that leave out i terms at either end, so S(phi) = (1, -phi) D (1, -phi)'.

    lagged: Σ w_t w_{t+k} for k = 0..p; head: first p values; tail: last p values, newest first.
    """
    p = lagged.shape[1] - 1
    d = np.zeros((len(lagged), p + 1, p + 1))
    for i in range(p + 1):
        for j in range(i, p + 1):
            k = j - i
            ends = sum((head[:, t] * head[:, t + k] + tail[:, t] * tail[:, t + k] for t in range(i)), np.zeros(len(lagged)))
            d[:, i, j] = d[:, j, i] = lagged[:, k] - ends
    return d


def _lower(columns: np.ndarray) -> np.ndarray:
    """The lower triangular Toeplitz matrices with these first columns."""
    p = columns.shape[-1]
    at = np.arange(p)[:, None] - np.arange(p)
    return np.where(at >= 0, columns[..., np.maximum(at, 0)], 0.0)


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b' + b a' of matrices."""
    x = a @ np.swapaxes(b, -1, -2)
    return x + np.swapaxes(x, -1, -2)


def _slopes(p: int) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the two factors of ``precisions`` by each coefficient: constant matrices."""
    left = _lower(-np.eye(p + 1)[1:, :p])
    return left, _lower(-np.eye(p)[::-1])


def precisions(phi: np.ndarray) -> np.ndarray:
    """M = L L' - U U' for each row of phi, the inverse covariance of p successive values at unit noise.
    It is positive definite exactly if the recursion is stationary."""
    left, right = _lower(np.c_[np.ones(len(phi)), -phi[:, :-1]]), _lower(-phi[:, ::-1])
    return left @ np.swapaxes(left, 1, 2) - right @ np.swapaxes(right, 1, 2)


def precision_slopes(phi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First (series, k, p, p) and second (k, l, p, p) derivatives of ``precisions``."""
    left, right = _lower(np.c_[np.ones(len(phi)), -phi[:, :-1]]), _lower(-phi[:, ::-1])
    d_left, d_right = _slopes(phi.shape[1])
    first = _both(d_left[None], left[:, None]) - _both(d_right[None], right[:, None])
    return first, _both(d_left[:, None], d_left[None]) - _both(d_right[:, None], d_right[None])


def start_precision(phi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``precisions`` of one series with its first and second derivatives."""
    first, second = precision_slopes(phi[None])
    return precisions(phi[None])[0], first[0], second


def _half_log_det(m: np.ndarray) -> np.ndarray:
    """Half the logarithm of each determinant by elimination; -inf where a matrix is not positive definite."""
    m, total, good = m.copy(), np.zeros(len(m)), np.ones(len(m), bool)
    for j in range(m.shape[1]):
        good &= m[:, j, j] > 0
        pivot = np.where(good, m[:, j, j], 1.0)
        total += 0.5 * np.log(pivot)
        m[:, j + 1:, j + 1:] -= m[:, j + 1:, j, None] * m[:, None, j, j + 1:] / pivot[:, None, None]
    return np.where(good, total, -np.inf)


def _objective(phi: np.ndarray, d: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log-likelihood over phi with the noise variance at its best, up to a constant."""
    u = np.c_[np.ones(len(phi)), -phi]
    s = np.einsum("bi,bij,bj->b", u, d, u)
    good = s > 0
    return np.where(good, -0.5 * n * np.log(np.where(good, s, 1.0)) + _half_log_det(precisions(phi)), -np.inf)


def _yule_walker(lagged: np.ndarray) -> np.ndarray:
    """Always stationary: where the search starts."""
    p = lagged.shape[1] - 1
    gamma = lagged[:, np.abs(np.arange(p)[:, None] - np.arange(p))]
    return np.linalg.solve(gamma + 1e-9 * lagged[:, :1, None] * np.eye(p), lagged[:, 1:, None])[..., 0]


def exact_fits(lagged: np.ndarray, n: np.ndarray, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, noise standard deviation and log-likelihood of the exact maximum, a row a series.

    Newton steps, damped where the curvature asks for it, halved until the likelihood rises; all series
    take their steps together, and one that has arrived leaves the round."""
    p = lagged.shape[1] - 1
    phi, sigma, loglik = np.zeros((len(lagged), p)), np.zeros(len(lagged)), np.full(len(lagged), math.inf)
    some = np.flatnonzero(lagged[:, 0] > 0)  # the others have no difference at all
    if not len(some):
        return phi, sigma, loglik
    n, d = np.asarray(n, float)[some], product_matrices(lagged[some], head[some], tail[some])
    at = _yule_walker(lagged[some])
    value = _objective(at, d, n)
    while (far := ~np.isfinite(value)).any():
        at[far] /= 2
        value[far] = _objective(at[far], d[far], n[far])
    live = np.arange(len(some))
    for _ in range(100):
        x, dl, nl = at[live], d[live], n[live]
        u = np.c_[np.ones(len(x)), -x]
        du = np.einsum("bij,bj->bi", dl, u)
        s, ds, dds = np.einsum("bi,bi->b", u, du)[:, None], -2 * du[:, 1:], 2 * dl[:, 1:, 1:]
        inv = np.linalg.inv(precisions(x))
        first, second = precision_slopes(x)
        turned = inv[:, None] @ first
        gradient = -0.5 * nl[:, None] * ds / s + 0.5 * np.einsum("bkii->bk", turned)
        curve = (-0.5 * nl[:, None, None] * (dds / s[..., None] - ds[:, :, None] * ds[:, None] / s[..., None]**2)
                 + 0.5 * (np.einsum("bij,klji->bkl", inv, second) - np.einsum("bkij,blji->bkl", turned, turned)))
        top = np.linalg.eigvalsh(curve)[:, -1]
        damp = np.where(top >= 0, top + 1e-3 * np.abs(top) + 1e-9, 0.0)
        step = np.linalg.solve(curve - damp[:, None, None] * np.eye(p), -gradient[..., None])[..., 0]
        size, got = np.ones(len(live)), np.full(len(live), -np.inf)
        open_ = np.arange(len(live))
        while len(open_):
            got[open_] = _objective(x[open_] + size[open_, None] * step[open_], dl[open_], nl[open_])
            open_ = open_[~(got[open_] >= value[live[open_]])]
            size[open_] /= 2
            open_ = open_[size[open_] > 1e-12]
        up = size > 1e-12
        at[live[up]] += size[up, None] * step[up]
        value[live[up]] = got[up]
        live = live[up & ~(np.abs(size[:, None] * step).max(1) < 1e-12)]
        if not len(live):
            break
    u = np.c_[np.ones(len(at)), -at]
    phi[some], sigma[some] = at, np.sqrt(np.einsum("bi,bij,bj->b", u, d, u) / n)
    loglik[some] = value - 0.5 * n * (1 + math.log(2 * math.pi) - np.log(n))
    return phi, sigma, loglik


def exact_fit(lagged: np.ndarray, n: int, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, float, float]:
    """``exact_fits`` of one series."""
    phi, sigma, loglik = exact_fits(*(np.asarray(v, float)[None] for v in (lagged, n, head, tail)))
    return phi[0], float(sigma[0]), float(loglik[0])


def _fit_exact(train: DataFrame, p: int) -> DataFrame:
    """(symbol, n_train, coef, sigma, error, loglik) from aggregates of the differences."""
    dy = F.col("dy")
    ends = train.where(dy.isNotNull()).groupBy("symbol").agg(
        F.count(dy).alias("n"), F.sum(dy * dy).alias("s0"),
        *[F.sum(dy * F.element_at("x", k)).alias(f"s{k}") for k in range(1, p + 1)],
        # differences start in the second row: at most p entries a symbol
        F.sort_array(F.collect_list(F.when(F.col("rn") <= p + 1, F.struct("rn", "dy")))).alias("head"),
        F.max_by(F.struct("dy", "x"), "rn").alias("last"))
    sums = ends.select("symbol", "n", F.array(*[F.coalesce(f"s{k}", F.lit(0.0)) for k in range(p + 1)]).alias("lagged"),
                       F.col("head.dy").alias("head"),
                       F.concat(F.array("last.dy"), F.slice("last.x", 1, p - 1)).alias("tail"))

    def solve(batches):
        for pdf in batches:
            need = 2 * p + 1
            good = pdf["n"].to_numpy() >= need
            fits = iter(zip(*exact_fits(*(np.array(pdf.loc[good, c].tolist(), float).reshape(good.sum(), *size) for c, size in (
                ("lagged", (p + 1,)), ("n", ()), ("head", (p,)), ("tail", (p,)))))))
            out = []
            for symbol, n, fitted in zip(pdf["symbol"], pdf["n"], good):
                coef, sigma, loglik = next(fits) if fitted else (None, None, None)
                out.append((symbol, n, coef, sigma, None if fitted else f"insufficient rows: {n} < {need}", loglik))
            yield pd.DataFrame(out, columns=["symbol", "n_train", "coef", "sigma", "error", "loglik"])

    return sums.mapInPandas(solve, "symbol string, n_train long, coef array<double>, sigma double, error string, loglik double")


def fit_ar(ds: DataFrame, p: int = P_DEFAULT, method: str = "exact") -> DataFrame:
    """Per-symbol AR(p) coefficients on the train split, plus forecast state:
    the last p train differences (newest first) and the last train close.

    ``method``: exact (maximum likelihood, ``n_train`` differences) or conditional (least squares)."""
    train = ds.where(F.col("split") == "train")
    if method == "exact":
        fit = _fit_exact(train, p)
    elif method == "conditional":
        rows = train.where(F.col("dy").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
        fit = fit_least_squares(rows.select("symbol", "x", F.col("dy").alias("y")), p, min_rows=p + 1).withColumn(
            "loglik", F.lit(None).cast("double"))
    else:
        raise ValueError(f"unknown method: {method}")
    last = train.groupBy("symbol").agg(
        F.max_by(F.struct("close", "dy", "x"), "rn").alias("_last"),
        F.count(F.lit(1)).alias("n_train_rows"),
        F.max("date").alias("last_train_date"))
    state = last.select(
        "symbol", "n_train_rows", "last_train_date",
        F.col("_last.close").alias("last_close"),
        F.concat(F.array(F.col("_last.dy")), F.slice(F.col("_last.x"), 1, p - 1)).alias("last_diffs"))
    # serving state: the newest p differences of the whole series (train + test)
    w_all = Window.partitionBy("symbol").orderBy("rn")
    full = ds.withColumn("_d", F.col("close") - F.lag("close", 1).over(w_all))
    full = full.withColumn("_dl", F.array(*[F.lag("_d", i).over(w_all) for i in range(p)]))
    serve = full.groupBy("symbol").agg(F.max_by(F.struct("close", "_dl", "date"), "rn").alias("_s")).select(
        "symbol", F.col("_s.close").alias("serve_last_close"), F.col("_s._dl").alias("serve_last_diffs"),
        F.col("_s.date").alias("serve_as_of"))
    return fit.join(state, "symbol", "right").join(serve, "symbol", "left").select(
        "symbol", F.coalesce("n_train", F.lit(0).cast("long")).alias("n_train"), "coef", "sigma", "loglik",
        F.coalesce("error", F.when(F.col("coef").isNull(), F.lit("insufficient rows"))).alias("error"),
        "last_close", "last_diffs", "last_train_date", "serve_last_close", "serve_last_diffs", "serve_as_of")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)


def ar_forecast_expr(coef: Column, last_diffs: Column, last_close: Column, h: Column, p: int = P_DEFAULT) -> Column:
    """M4: array of h forecasts; Δŷ = φ·(recent diffs), level re-integrated."""
    init = F.struct(last_diffs.alias("d"), last_close.alias("lvl"),
                    F.array().cast("array<double>").alias("out"))

    def step(acc, _i):
        dy = dot(coef, acc["d"])
        lvl = acc["lvl"] + dy
        return F.struct(F.concat(F.array(dy), F.slice(acc["d"], 1, p - 1)).alias("d"),
                        lvl.alias("lvl"), F.concat(acc["out"], F.array(lvl)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), h), init, step, lambda acc: acc["out"])


def ar_band_expr(coef: Column, sigma: Column, h: Column, p: int = P_DEFAULT) -> Column:
    """Standard error of the 1..h-step level forecasts: sigma times the root of the summed squares
    of the cumulated moving-average weights of the fitted recursion."""
    init = F.struct(F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), p - 1)).alias("psi"),
                    F.lit(1.0).alias("cum"), F.lit(1.0).alias("ss"), F.array().cast("array<double>").alias("out"))

    def step(acc, _i):
        nxt = dot(coef, acc["psi"])
        cum = acc["cum"] + nxt
        return F.struct(F.concat(F.array(nxt), F.slice(acc["psi"], 1, p - 1)).alias("psi"), cum.alias("cum"),
                        (acc["ss"] + cum * cum).alias("ss"),
                        F.concat(acc["out"], F.array(sigma * F.sqrt(acc["ss"]))).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), h), init, step, lambda acc: acc["out"])


def extend(coef: np.ndarray, diffs: np.ndarray, close: float, h: int) -> np.ndarray:
    """The next h levels by doubling: a block of states known, the power of the companion matrix
    that carries its first state past its end carries all of it, so h steps take log2(h) products."""
    p = len(coef)
    step = np.zeros((p + 1, p + 1))  # (diffs newest first, level) -> one step later
    step[0, :p] = coef
    step[1:p, : p - 1] = np.eye(p - 1)
    step[p, :p], step[p, p] = coef, 1.0
    states, carry = (step @ np.r_[diffs, close])[:, None], step
    while states.shape[1] < h:
        states = np.concatenate([states, carry @ states], 1)
        carry = carry @ carry
    return states[p, :h]


def forecast_steps(fit: DataFrame, block: int = 1 << 16) -> DataFrame:
    """M4: (symbol, step, yhat) for steps 1..h of each fit (coef, last_diffs, last_close, h), in blocks of rows."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                levels = extend(np.asarray(r.coef, float), np.asarray(r.last_diffs, float), r.last_close, int(r.h))
                for at in range(0, len(levels), block):
                    own = levels[at: at + block]
                    yield pd.DataFrame({"symbol": r.symbol, "step": np.arange(at + 1, at + 1 + len(own), dtype=np.int32), "yhat": own})

    return fit.select("symbol", "coef", "last_diffs", "last_close", "h").mapInPandas(run, "symbol string, step int, yhat double")


def evaluate_ar(ds: DataFrame, fit: DataFrame, p: int = P_DEFAULT) -> DataFrame:
    """Forecast the whole test block per symbol and align positionally (J1,
    step = position within the test split), then A1 metrics."""
    test = ds.where(F.col("split") == "test").select(
        "symbol", "date", F.col("close").alias("y"),
        (F.col("rn") - F.floor(F.col("n") * 4 / 5)).cast("int").alias("step"))
    h = test.groupBy("symbol").agg(F.max("step").alias("h"))
    fc = forecast_steps(fit.where(F.col("error").isNull()).join(h, "symbol"))
    pred = align_actual_predicted(test, fc, ("symbol", "step"))
    return regression_metrics(pred, ("symbol",))


def train_series(closes: list[np.ndarray], p: int = P_DEFAULT) -> list[dict | None]:
    """``ar_dataset``, ``fit_ar`` and ``evaluate_ar`` of some symbols at once, each given by its closes in
    date order: a dict of coef, error, state and metrics; None without a row to learn from."""
    need, out, fitted = 2 * p + 1, [], []
    for y in closes:
        y = y[~np.isnan(y)]
        m = len(y) * TRAIN_NUM // TRAIN_DEN
        d = np.diff(y[:m])
        newest = lambda v: [*v[:-p - 1:-1].tolist(), *[None] * (p - len(v))]
        state = {"last_diffs": newest(d), "last_close": [y[m - 1]] if m else None, "serve_last_diffs": newest(np.diff(y)),
                 "serve_last_close": [y[-1]] if m else None, "sigma": [None]}
        error = f"insufficient rows: {len(d)} < {need}" if len(d) < need else None
        out.append({"coef": None, "error": error if len(d) else "insufficient rows", "state": state, "metrics": None} if m else None)
        if m and error is None:
            fitted.append((out[-1], d, y[m:]))
    if fitted:
        sums = [[d[: len(d) - k] @ d[k:] for k in range(p + 1)] for _, d, _ in fitted]
        fits = exact_fits(np.array(sums), np.array([len(d) for _, d, _ in fitted]), np.array([d[:p] for _, d, _ in fitted]),
                          np.array([d[:-p - 1:-1] for _, d, _ in fitted]))
        for (one, d, test), coef, sigma in zip(fitted, *fits[:2]):
            one["coef"], one["state"]["sigma"] = coef, [sigma]
            if len(test):
                one["metrics"] = metrics_of(test, extend(coef, d[:-p - 1:-1], one["state"]["last_close"][0], len(test)))
    return out
