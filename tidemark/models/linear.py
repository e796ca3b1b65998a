"""M1/M2: per-symbol linear regression of next-day close on indicator features.

The Gram matrix is centred per symbol and comes from Spark's ``covar_pop``
aggregates — numerically stable co-moments with partial (map-side)
aggregation — so a hot symbol is combined map-side like any other aggregate.
Only the k×k solve runs in Python, one row per symbol.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.models.solve import scaled_lstsq
from tidemark.operators.cleaning import LINEAR_FEATURES, drop_incomplete
from tidemark.operators.dataset import TRAIN_DEN, TRAIN_NUM, chronological_split
from tidemark.operators.evaluate import metrics_of, regression_metrics
from tidemark.operators.indicators import next_target, simple_feature_arrays, simple_features


def linear_dataset(bars: DataFrame, features=LINEAR_FEATURES) -> DataFrame:
    """Simplified features → drop incomplete rows → next-day target → 80/20 split."""
    feats = simple_features(bars)
    complete = drop_incomplete(feats)
    return chronological_split(next_target(complete.select("symbol", "date", "close", *features)))


def moments(train: DataFrame, features=LINEAR_FEATURES, target: str = "target") -> DataFrame:
    """Per symbol: row count, means ``m<i>`` and centred second moments ``c<i>_<j>`` of the
    features and, as the last one, the target."""
    cols = [*features, target]
    k = len(cols) - 1
    aggs = [F.count(F.lit(1)).alias("n_train")]
    aggs += [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i in range(k + 1) for j in range(i, k + 1)]
    return train.groupBy("symbol").agg(*aggs)


def fit_linear(ds: DataFrame, features=LINEAR_FEATURES, target: str = "target") -> DataFrame:
    """OLS with intercept per symbol on the train split.

    Returns ``(symbol, n_train, features, coef, intercept, error)``; a
    zero-variance feature gets coefficient 0 (minimum-norm solution).
    """
    feats = list(features)
    k = len(feats)
    mom = moments(ds.where(F.col("split") == "train"), feats, target)

    schema = T.StructType([T.StructField("symbol", T.StringType()),
                           T.StructField("n_train", T.LongType()),
                           T.StructField("coef", T.ArrayType(T.DoubleType())),
                           T.StructField("intercept", T.DoubleType()),
                           T.StructField("error", T.StringType())])

    def solve(batches):
        for pdf in batches:
            coefs, icpt, err = [], [], []
            for _, r in pdf.iterrows():
                if r["n_train"] < k + 1:
                    coefs.append(None)
                    icpt.append(None)
                    err.append(f"insufficient rows: {int(r['n_train'])} < {k + 1}")
                    continue
                C = np.empty((k, k))
                for i in range(k):
                    for j in range(i, k):
                        C[i, j] = C[j, i] = r[f"c{i}_{j}"]
                cxy = np.array([r[f"c{i}_{k}"] for i in range(k)])
                means = np.array([r[f"m{i}"] for i in range(k)])
                beta = scaled_lstsq(C, cxy, means)
                coefs.append(beta.tolist())
                icpt.append(float(r[f"m{k}"] - beta @ means))
                err.append(None)
            yield pd.DataFrame({"symbol": pdf["symbol"], "n_train": pdf["n_train"].astype("int64"),
                                "coef": coefs, "intercept": icpt, "error": err})

    fit = mom.mapInPandas(solve, schema)
    return fit.select("symbol", "n_train", F.array(*[F.lit(c) for c in feats]).alias("features"),
                      "coef", "intercept", "error")


def complete_features(close: np.ndarray, volume: np.ndarray, whole: np.ndarray, features=LINEAR_FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """The features of one symbol's bars in date order, and which rows are complete."""
    got = simple_feature_arrays(close, volume)
    kept = whole & ~np.isnan(np.column_stack([close, volume, got["MA_5"], got["MA_20"], got["Volume_MA"]])).any(1)
    return np.column_stack([got[c] for c in features]), kept


def train_series(close: np.ndarray, volume: np.ndarray, whole: np.ndarray, features=LINEAR_FEATURES) -> dict | None:
    """``linear_dataset``, ``fit_linear`` and ``evaluate_linear`` of one symbol's bars in date order (NaN is null,
    ``whole``: nothing is missing in a bar's other columns); None without a row to learn from."""
    x, kept = complete_features(close, volume, whole, features)
    x, y = x[kept][:-1], close[kept][1:]
    k, m = len(features), len(y) * TRAIN_NUM // TRAIN_DEN
    if not m:
        return None
    if m < k + 1:
        return {"coef": None, "intercept": None, "error": f"insufficient rows: {m} < {k + 1}", "state": {}, "metrics": None}
    mx, my = x[:m].mean(0), y[:m].mean()
    dx = x[:m] - mx
    coef = scaled_lstsq(dx.T @ dx / m, dx.T @ (y[:m] - my) / m, mx)
    intercept = float(my - coef @ mx)
    return {"coef": coef, "intercept": intercept, "error": None, "state": {}, "metrics": metrics_of(y[m:], intercept + x[m:] @ coef)}


def linear_predict(features: list[str], coef: Column | None = None,
                   intercept: Column | None = None) -> Column:
    """M2: intercept + Σ coef[i]·feature[i]."""
    coef = F.col("coef") if coef is None else coef
    intercept = F.col("intercept") if intercept is None else intercept
    terms = [F.element_at(coef, i + 1) * F.col(c) for i, c in enumerate(features)]
    out = intercept
    for t in terms:
        out = out + t
    return out


def newest_features(bars: DataFrame, features=LINEAR_FEATURES) -> DataFrame:
    """``(symbol, as_of, <features>)`` of the newest complete row of each symbol."""
    complete = drop_incomplete(simple_features(bars)).select("symbol", "date", *features)
    newest = complete.groupBy("symbol").agg(F.max_by(F.struct("date", *features), "date").alias("_r"))
    return newest.select("symbol", F.col("_r.date").alias("as_of"), *[F.col(f"_r.{c}").alias(c) for c in features])


def forecast_linear(fit: DataFrame, bars: DataFrame, features=LINEAR_FEATURES) -> DataFrame:
    """M2 on the newest row: the next close, ``(symbol, as_of, yhat)``."""
    good = fit.where(F.col("error").isNull()).select("symbol", "coef", "intercept")
    return newest_features(bars, features).join(good, "symbol").select(
        "symbol", "as_of", linear_predict(list(features)).alias("yhat"))


def evaluate_linear(ds: DataFrame, fit: DataFrame, features=LINEAR_FEATURES,
                    target: str = "target") -> DataFrame:
    """Test-split predictions joined to the per-symbol coefficients, then A1 metrics."""
    test = ds.where(F.col("split") == "test")
    pred = test.join(fit.where(F.col("error").isNull()).select("symbol", "coef", "intercept"), "symbol")
    pred = pred.select("symbol", "date", F.col(target).alias("y"),
                       linear_predict(list(features)).alias("yhat"))
    return regression_metrics(pred, ("symbol",))


def fit_linear_1f(ds: DataFrame, feature: str = "MA_5", target: str = "target") -> DataFrame:
    """Single-feature OLS with built-in ``regr_slope``/``regr_intercept``."""
    train = ds.where(F.col("split") == "train")
    return train.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_train"),
        F.regr_slope(target, feature).alias("slope"),
        F.regr_intercept(target, feature).alias("intercept"))
