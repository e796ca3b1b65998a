"""M8/M9: one-step regressor on flattened look-back windows, and its rollout.

Samples are the reference's look-back windows (60 steps × 7 scaled features,
W11) with the next scaled close as target. The recurrent network is not built;
a ridge regression over the 420 flattened inputs (+ intercept) is fitted per
symbol from distributed partial Gram sums. Multi-step prediction is the
reference's recursive rollout, expressed as an ``aggregate`` over the step
sequence on an array state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.models.ar import dot
from tidemark.models.solve import SOLUTION, fit_least_squares
from tidemark.operators.cleaning import SEQUENCE_FEATURES, drop_incomplete, select_features
from tidemark.operators.dataset import (LOOKBACK, chronological_split, lookback_sequences, minmax_inverse,
                                        minmax_scale, scale_features, tail_n, train_size, TRAIN_DEN, TRAIN_NUM)
from tidemark.operators.evaluate import metrics_of, regression_metrics
from tidemark.operators.indicators import indicator_arrays

RIDGE = 1.0  # L2 penalty on the 420 scaled inputs (the intercept is not penalised)
NF = len(SEQUENCE_FEATURES)


def flatten_steps(x: Column) -> Column:
    """array<struct<7 features>> → array<double> (step-major), with a leading 1."""
    per_step = F.transform(x, lambda s: F.array(*[s[c] for c in SEQUENCE_FEATURES]))
    return F.concat(F.array(F.lit(1.0)), F.flatten(per_step))


def sequence_rows(indicators: DataFrame, fit_on: str = "train", lookback: int = LOOKBACK) -> DataFrame:
    """Complete, scaled rows, numbered from the first one with a whole look-back before it;
    split 80/20 over those. Keeps the scaler of all features (``scale_min``, ``scale_max``)."""
    base = drop_incomplete(select_features(indicators, SEQUENCE_FEATURES))
    scaled = scale_features(base, SEQUENCE_FEATURES, fit_on)
    if fit_on != "train":
        scaled = chronological_split(scaled)
    rn, n = F.col("rn") - lookback, F.col("n") - lookback
    return scaled.select(
        "symbol", "date", *SEQUENCE_FEATURES, rn.alias("rn"), n.alias("n"),
        F.when(rn <= train_size(n), F.lit("train")).otherwise(F.lit("test")).alias("split"),
        "close_min", "close_max", F.array(*[f"{c}_min" for c in SEQUENCE_FEATURES]).alias("scale_min"),
        F.array(*[f"{c}_max" for c in SEQUENCE_FEATURES]).alias("scale_max"))


def sequence_dataset(indicators: DataFrame, fit_on: str = "train", lookback: int = LOOKBACK) -> DataFrame:
    """``sequence_rows`` → windows → flattened ``xf`` and scaled ``y``; the split is decided on
    the narrow rows before any window is built."""
    seq = lookback_sequences(sequence_rows(indicators, fit_on, lookback), SEQUENCE_FEATURES, lookback)
    return seq.withColumn("xf", flatten_steps(F.col("x"))).drop("x")


def windows_of(x: np.ndarray, n: int, lookback: int = LOOKBACK) -> np.ndarray:
    """The first n windows over the rows x, each as one row; window i holds the rows i .. i + lookback - 1."""
    return np.lib.stride_tricks.sliding_window_view(x.ravel(), lookback * x.shape[1])[:: x.shape[1]][:n].copy()


def ridge_fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Coefficients (the intercept first, without penalty) and ``sigma`` of ``fit_sequence``; centres x in place.
    With fewer rows than unknowns the system is solved for the rows' weights: (X'X + r)^-1 X'y = X'(XX' + r)^-1 y."""
    n, k = x.shape
    mx, my = x.mean(0), y.mean()
    x -= mx
    a = x @ x.T if n <= k else x.T @ x
    a.ravel()[:: len(a) + 1] += ridge
    coef = x.T @ np.linalg.solve(a, y - my) if n <= k else np.linalg.solve(a, x.T @ (y - my))
    e = y - my - x @ coef
    return np.r_[my - mx @ coef, coef], float(np.sqrt(e @ e / max(n - k - 1, 1)))


def train_windows(x: np.ndarray, m: int, lookback: int = LOOKBACK, ridge: float = RIDGE) -> dict | None:
    """Fit and scaled test metrics from the scaled rows of one symbol: the first m windows are learned from, the
    rest is forecast. None without a window to learn from."""
    if m < 1:
        return None
    if m < 2:
        return {"n_train": m, "coef": None, "sigma": None, "error": f"insufficient rows: {m} < 2", "metrics": None}
    y = x[lookback:, SEQUENCE_FEATURES.index("close")]
    coef, sigma = ridge_fit(windows_of(x, m, lookback), y[:m], ridge)
    yhat = coef[0] + windows_of(x[m:], len(y) - m, lookback) @ coef[1:]
    return {"n_train": m, "coef": coef, "sigma": sigma, "error": None, "metrics": metrics_of(y[m:], yhat)}


def train_sequences(rows: DataFrame, lookback: int = LOOKBACK, ridge: float = RIDGE) -> DataFrame:
    """Fits, scalers and scaled test metrics of all symbols in one pass over ``sequence_rows``: equal to
    ``fit_sequence``, ``scalers`` and ``evaluate_sequence`` of their dataset, but a row's look-back is
    60 times the row, so the windows are taken here from the rows of the symbol."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True).sort_values("rn")  # narrow daily rows of one symbol
        got = train_windows(pdf[SEQUENCE_FEATURES].to_numpy(float), int(((pdf["rn"] > 0) & (pdf["split"] == "train")).sum()), lookback, ridge)
        if got is None:
            return
        n, m = len(pdf) - lookback, got["n_train"]
        row = {"n": n - m if got["metrics"] else 0, **(got["metrics"] or dict.fromkeys(("mae", "mse", "rmse", "r2")))}
        yield pd.DataFrame([{"symbol": pdf["symbol"].iloc[0], "n_train": m, "coef": got["coef"], "sigma": got["sigma"], "error": got["error"],
                             "scale_min": pdf["scale_min"].iloc[0], "scale_max": pdf["scale_max"].iloc[0], **row}])

    cols = ["symbol", *SEQUENCE_FEATURES, "rn", "split", "scale_min", "scale_max"]
    return rows.where(F.col("symbol").isNotNull()).select(*cols).groupBy("symbol").applyInPandas(
        run, f"{SOLUTION}, scale_min array<double>, scale_max array<double>, n long, mae double, mse double, rmse double, r2 double")


def complete_rows(close: np.ndarray, volume: np.ndarray, dated: np.ndarray) -> np.ndarray:
    """The sequence features of one symbol's complete rows."""
    got = {"close": close, "volume": volume, **indicator_arrays(close, volume)}
    x = np.column_stack([got[c] for c in SEQUENCE_FEATURES])
    return x[dated & ~np.isnan(x).any(1)]


def train_series(close: np.ndarray, volume: np.ndarray, dated: np.ndarray, lookback: int = LOOKBACK, ridge: float = RIDGE) -> dict | None:
    """``sequence_dataset``, ``fit_sequence``, ``scalers`` and the scaled metrics of ``evaluate_sequence`` of one symbol's
    bars in date order (NaN is null, ``dated``: a bar has a date); None without a window to learn from."""
    x = complete_rows(close, volume, dated)
    m = (len(x) - lookback) * TRAIN_NUM // TRAIN_DEN  # a row a window
    if m < 1:
        return None
    train = x[: len(x) * TRAIN_NUM // TRAIN_DEN]
    lo, hi = train.min(0), train.max(0)
    got = train_windows(np.where(hi > lo, (x - lo) / np.where(hi > lo, hi - lo, 1.0), 0.0), m, lookback, ridge)
    return {**got, "state": {"sigma": [got["sigma"]], "scale_min": lo, "scale_max": hi}}


def scalers(ds: DataFrame) -> DataFrame:
    """``(symbol, scale_min, scale_max)`` of a dataset: part of the model, reused when serving."""
    return ds.groupBy("symbol").agg(F.first("scale_min").alias("scale_min"), F.first("scale_max").alias("scale_max"))


def fit_sequence(ds: DataFrame, lookback: int = LOOKBACK, ridge: float = RIDGE) -> DataFrame:
    k = 1 + lookback * NF
    train = ds.where(F.col("split") == "train").select("symbol", F.col("xf").alias("x"), "y")
    pen = [0.0] + [ridge] * (k - 1)
    return fit_least_squares(train, k, penalty=pen, min_rows=2)


def evaluate_sequence(ds: DataFrame, fit: DataFrame) -> DataFrame:
    """Test metrics in scaled space (as the reference reports) and in price space."""
    test = ds.where(F.col("split") == "test")
    pred = test.join(fit.where(F.col("error").isNull()).select("symbol", "coef"), "symbol").select(
        "symbol", "y", dot(F.col("coef"), F.col("xf")).alias("yhat"), "close_min", "close_max")
    scaled = regression_metrics(pred, ("symbol",)).withColumn("metric_space", F.lit("scaled"))
    price = regression_metrics(pred.select(
        "symbol", minmax_inverse(F.col("y"), F.col("close_min"), F.col("close_max")).alias("y"),
        minmax_inverse(F.col("yhat"), F.col("close_min"), F.col("close_max")).alias("yhat")),
        ("symbol",)).withColumn("metric_space", F.lit("price"))
    return scaled.unionByName(price)


def latest_window(indicators: DataFrame, scaler: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """The newest ``lookback`` complete rows per symbol, scaled by the model's own
    ``scaler(symbol, scale_min, scale_max)`` and flattened as the rollout's initial
    input. Bars before the window play no part."""
    base = drop_incomplete(select_features(indicators, SEQUENCE_FEATURES))
    last = tail_n(base, lookback)
    step = F.struct("date", *[F.col(c) for c in SEQUENCE_FEATURES])
    g = last.groupBy("symbol").agg(F.sort_array(F.collect_list(step)).alias("_win"), F.max("date").alias("as_of"))
    g = g.where(F.size("_win") == lookback).join(scaler.select("symbol", "scale_min", "scale_max"), "symbol")

    def scaled(s):
        return F.array(*[minmax_scale(s[c], F.element_at("scale_min", i + 1), F.element_at("scale_max", i + 1))
                         for i, c in enumerate(SEQUENCE_FEATURES)])

    close = SEQUENCE_FEATURES.index("close") + 1
    return g.select("symbol", "as_of", F.element_at("scale_min", close).alias("close_min"),
                    F.element_at("scale_max", close).alias("close_max"),
                    F.flatten(F.transform("_win", scaled)).alias("window"))


def rollout_expr(coef: Column, window: Column, h: Column, carry: str = "roll",
                 lookback: int = LOOKBACK) -> Column:
    """M9: recursive h-step prediction in scaled space.

    Each step predicts from the current window, drops the oldest step and
    appends a step whose close is the prediction; its other features are those
    of the dropped oldest step (``carry="roll"``, the reference's wrap-around)
    or of the newest step (``carry="last"``)."""
    size = lookback * NF
    init = F.struct(window.alias("w"), F.array().cast("array<double>").alias("out"))

    def step(acc, _i):
        pred = dot(coef, F.concat(F.array(F.lit(1.0)), acc["w"]))
        src = F.slice(acc["w"], 2, NF - 1) if carry == "roll" else F.slice(acc["w"], size - NF + 2, NF - 1)
        new_w = F.concat(F.slice(acc["w"], NF + 1, size - NF), F.array(pred), src)
        return F.struct(new_w.alias("w"), F.concat(acc["out"], F.array(pred)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), h), init, step, lambda acc: acc["out"])


def newest_window(close: np.ndarray, volume: np.ndarray, dated: np.ndarray, lookback: int = LOOKBACK) -> np.ndarray | None:
    """The newest ``lookback`` complete rows of one symbol's bars as ``latest_window`` takes them, not scaled."""
    x = complete_rows(close, volume, dated)
    return x[-lookback:].ravel() if len(x) >= lookback else None


def rollouts(coef: np.ndarray, window: np.ndarray, lo: np.ndarray, hi: np.ndarray, h: int, carry: str = "roll") -> np.ndarray:
    """``rollout_expr`` in price space of many symbols at once: a row each of coefficients, of the window (not scaled)
    and of the scaler's minima and maxima."""
    spread = np.where(hi > lo, hi - lo, 1.0)[:, None]
    steps = window.reshape(len(window), -1, NF)
    lookback = steps.shape[1]
    w = np.empty((len(window), lookback + h, NF))
    w[:, :lookback] = np.where((hi > lo)[:, None], (steps - lo[:, None]) / spread, 0.0)
    out = np.empty((len(window), h))
    for i in range(h):
        out[:, i] = coef[:, 0] + np.einsum("bk,bk->b", coef[:, 1:], w[:, i: i + lookback].reshape(len(window), -1))
        w[:, lookback + i] = w[:, i if carry == "roll" else lookback + i - 1]
        w[:, lookback + i, 0] = out[:, i]
    close = SEQUENCE_FEATURES.index("close")
    return minmax_inverse(out, lo[:, close, None], hi[:, close, None])


def predict_sequence(fit: DataFrame, windows: DataFrame, h: int | Column = 30, carry: str = "roll") -> DataFrame:
    """Price-space rollouts ``(symbol, as_of, predictions array<double>)``."""
    hc = F.lit(h) if isinstance(h, int) else h
    j = windows.join(fit.where(F.col("error").isNull()).select("symbol", "coef", "sigma"), "symbol")
    scaled = rollout_expr(F.col("coef"), F.col("window"), hc, carry)
    return j.select("symbol", "as_of", "sigma", "close_min", "close_max",
                    F.transform(scaled, lambda v: minmax_inverse(v, F.col("close_min"), F.col("close_max")))
                    .alias("predictions"))


BLOCK = 256  # steps that one product of the companion form advances


def companion(coef: np.ndarray, carry: str = "roll", lookback: int = LOOKBACK) -> np.ndarray:
    """One step of the rollout as a matrix on the state (1, window)."""
    size = lookback * NF
    step = np.zeros((size + 1, size + 1))
    step[0, 0] = 1.0
    kept = np.arange(size - NF)
    step[1 + kept, 1 + NF + kept] = 1.0  # the window moves up by one row
    step[1 + size - NF] = coef
    others = np.arange(1, NF)
    step[1 + size - NF + others, 1 + others + (0 if carry == "roll" else size - NF)] = 1.0
    return step


def rollout(coef: np.ndarray, window: np.ndarray, h: int, carry: str = "roll", lookback: int = LOOKBACK) -> Iterator[np.ndarray]:
    """The h predictions of ``rollout_expr`` in blocks: the states of a block by doubling, each further
    block by one product with the power of the step that spans it."""
    step = companion(coef, carry, lookback)
    states = np.r_[1.0, window][:, None]
    while states.shape[1] < min(BLOCK, h):
        states = np.concatenate([states, step @ states], 1)
        step = step @ step
    done = 0
    while done < h:
        yield (coef @ states)[: h - done]
        done += states.shape[1]
        states = step @ states


def rollout_steps(fit: DataFrame, windows: DataFrame, h: int, carry: str = "roll") -> DataFrame:
    """M9 for long horizons: (symbol, step, yhat) in price space, a bounded block of rows at a time."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                at = 0
                for block in rollout(np.asarray(r.coef, float), np.asarray(r.window, float), h, carry):
                    yield pd.DataFrame({"symbol": r.symbol, "step": np.arange(at + 1, at + 1 + len(block), dtype=np.int32),
                                        "yhat": block * (r.close_max - r.close_min) + r.close_min})
                    at += len(block)

    j = windows.join(fit.where(F.col("error").isNull()).select("symbol", "coef"), "symbol")
    return j.select("symbol", "coef", "window", "close_min", "close_max").mapInPandas(run, "symbol string, step int, yhat double")
