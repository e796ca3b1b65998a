"""Train one model type for every symbol and emit ``models`` rows.

Dispatch on the model type (``linear``, ``arima``, ``prophet``, ``lstm``);
every branch fits all symbols in parallel, in one pass over the bars, and returns the same schema:
``(model_type, symbol, created_at, features, coef, intercept, params,
metrics, state, error)`` where ``state`` carries what forecasting needs.
"""

from __future__ import annotations

import datetime as dt
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models import ar, linear, sequence, trend_seasonal
from tidemark.operators.cleaning import LINEAR_FEATURES, SEQUENCE_FEATURES
from tidemark.operators.symbols import map_symbols
from tidemark.session import stored

MODEL_TYPES = ("linear", "arima", "prophet", "lstm")


def _params(d: dict) -> F.Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(str(v))]
    return F.create_map(*items)


def _check(model_type: str) -> str:
    mt = model_type.lower()
    if mt not in MODEL_TYPES:
        raise ValueError(f"Unsupported model type: {model_type}")
    return mt


# Fixed of each type: the features and parameters its rows name.
FEATURES = {"linear": LINEAR_FEATURES, "arima": ["close"], "prophet": ["ds"], "lstm": SEQUENCE_FEATURES}
PARAMS = {
    "linear": {"train_test_split": 0.8, "features": ",".join(LINEAR_FEATURES)},
    "arima": {"order": "(5, 1, 0)", "train_test_split": 0.8},
    "prophet": {"changepoint_prior_scale": trend_seasonal.CHANGEPOINT_PRIOR_SCALE,
                "seasonality_prior_scale": trend_seasonal.SEASONALITY_PRIOR_SCALE,
                "weekly_seasonality": True, "yearly_seasonality": True},
    "lstm": {"lookback_window": 60, "ridge": sequence.RIDGE, "train_test_split": 0.8, "metric_space": "scaled"},
}
PART = 1 << 18  # bars of a partition, about
MODEL_ROW = pa.schema([("model_type", pa.string()), ("symbol", pa.string()), ("learned", pa.bool_()), ("coef", pa.list_(pa.float64())),
                       ("intercept", pa.float64()), ("error", pa.string()), ("metrics", pa.map_(pa.string(), pa.float64())),
                       ("state", pa.map_(pa.string(), pa.list_(pa.float64())))])


def _fits(mt: str, bars: list[dict[str, np.ndarray]]) -> list[dict | None]:
    """One type's dataset, fit and test metrics for each of some symbols; None: no row to learn from."""
    if mt == "linear":
        return [linear.train_series(b["close"], b["volume"], b["whole"]) for b in bars]
    if mt == "arima":
        return ar.train_series([b["close"] for b in bars])
    if mt == "prophet":
        return [trend_seasonal.train_series(b["day"], b["close"]) for b in bars]
    return [sequence.train_series(b["close"], b["volume"], ~np.isnan(b["day"])) for b in bars]


def _model_rows(symbols: list, bars: list[dict[str, np.ndarray]], types: list[str]) -> pa.RecordBatch:
    rows = []
    for mt in types:
        for symbol, got in zip(symbols, _fits(mt, bars)):
            got = None if symbol is None else got
            rows.append({"model_type": mt, "symbol": symbol, "learned": got is not None} | ({} if got is None else {
                "coef": got["coef"], "intercept": got.get("intercept", 0.0), "error": got["error"],
                "metrics": got["metrics"] and [*got["metrics"].items()], "state": [*got["state"].items()]}))
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in MODEL_ROW], schema=MODEL_ROW)


def _train(bars: DataFrame, types: list[str]) -> DataFrame:
    """A row per model type and symbol from one pass over the bars."""
    def run(symbols, series):
        return _model_rows(symbols, series, types)

    return map_symbols(bars, run, "model_type string, symbol string, learned boolean, coef array<double>, intercept double, error string, "
                                  "metrics map<string,double>, state map<string,array<double>>", bars.count() // PART)


def train_many(bars: DataFrame, model_types=MODEL_TYPES, created_at="2024-01-01 00:00:00",
               is_stored: bool = False) -> DataFrame:
    """Fit each of ``model_types`` for all symbols of ``bars``; unknown types raise.

    The bars are stored once, so that their ticks are read once whatever the number of models
    (``is_stored``: they are already), and dealt by symbol once: a symbol's daily bars are few, and every
    type takes its dataset, fit and test metrics from them where they are (``train_series`` of each model,
    equal to its dataset, fit and evaluation on whole tables). A symbol that cannot be fitted has a row with its error."""
    types = [_check(t) for t in model_types]
    out = stored(_train(bars if is_stored else stored(bars), types))
    by_type = lambda c: functools.reduce(lambda rest, mt: F.when(F.col("model_type") == mt, c(mt)).otherwise(rest), types, F.lit(None))
    lost = F.when(F.col("coef").isNull(), F.coalesce("error", F.lit("insufficient rows")))
    return out.select("model_type", "symbol", F.to_timestamp(F.lit(str(created_at))).alias("created_at"),
                      F.when(F.col("learned"), by_type(lambda mt: F.array(*[F.lit(c) for c in FEATURES[mt]]))).alias("features"), "coef",
                      "intercept", F.when(F.col("learned"), by_type(lambda mt: _params(PARAMS[mt]))).alias("params"),
                      F.coalesce("metrics", F.create_map().cast("map<string,double>")).alias("metrics"),
                      F.coalesce("state", F.create_map().cast("map<string,array<double>>")).alias("state"), lost.alias("error"))


def train_all(bars: DataFrame, model_type: str, created_at: dt.datetime | str) -> DataFrame:
    """``train_many`` of one type."""
    return train_many(bars, (model_type,), str(created_at))
