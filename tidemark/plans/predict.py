"""Batch prediction responses for a table of requests.

Forecasts are computed once per (symbol, model type) for the largest horizon
(30 steps) from the ``models`` table and the latest bars; requests are then
validated (P6) and joined to that forecast table, and each response slices the
first ``days_ahead`` values. The request side is the large one; the forecast
table has one row per (symbol, model type) and is joined without a forced
broadcast so the planner picks broadcast only when its measured size allows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.models import ar, linear, sequence, trend_seasonal
from tidemark.operators.cleaning import LINEAR_FEATURES, MAX_DAYS_AHEAD, validate_requests
from tidemark.operators.symbols import map_symbols

# Fixed values of the reference: confidence label per model type.
CONFIDENCE = {"lstm": "medium", "prophet": "high"}


def prediction_dates(as_of: Column, h: Column) -> Column:
    """as_of + 1..h calendar days."""
    return F.transform(F.sequence(F.lit(1), h), lambda i: F.date_add(as_of, i))


def confidence(model_type: Column) -> Column:
    """F7."""
    expr = F.lit(None).cast("string")
    for k, v in CONFIDENCE.items():
        expr = F.when(model_type == k, F.lit(v)).otherwise(expr)
    return expr


FORECASTS = ("model_type string, symbol string, metrics map<string,double>, predictions array<double>, "
             "lower array<double>, upper array<double>")
SYMBOLS = 1 << 10  # models of a partition, about
VALUES = pa.list_(pa.float64())


def _newest(bars: DataFrame, parts: int) -> DataFrame:
    """``(symbol, features, window)`` from one pass over the bars: the linear features of the newest complete row and
    the newest window of the sequence model (not scaled); null where there is none."""
    def run(symbols, series):
        found = [linear.complete_features(b["close"], b["volume"], b["whole"]) for b in series]
        return pa.RecordBatch.from_arrays([
            pa.array(symbols, pa.string()), pa.array([x[kept][-1] if kept.any() else None for x, kept in found], VALUES),
            pa.array([sequence.newest_window(b["close"], b["volume"], ~np.isnan(b["day"])) for b in series], VALUES)],
            names=["symbol", "features", "window"])

    return map_symbols(bars, run, "symbol string, features array<double>, window array<double>", parts)


def _answers(batch: pa.RecordBatch, *values) -> pa.RecordBatch:
    """Rows of ``FORECASTS``: the first columns of a batch, then predictions, lower and upper."""
    keep = ["model_type", "symbol", "metrics"]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [
        pa.nulls(batch.num_rows, VALUES) if v is None else pa.array(list(v), VALUES) for v in values], names=[*keep, "predictions", "lower", "upper"])


def _curves(h: int):
    """Forecasts and bands of the curve models for the h days after ``day``."""
    def run(batches):
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("symbol", "coef", "t0", "span", "y_scale", "sigma", "knots", "day")}
            got = [trend_seasonal.day_forecasts(symbol, day + np.arange(1, h + 1), np.array(coef), t0, span, y_scale, sigma, np.array(knots))
                   for symbol, coef, t0, span, y_scale, sigma, knots, day in zip(*cols.values())]
            yield _answers(batch, *zip(*got)) if got else _answers(batch, None, None, None)
    return run


def _rollouts(h: int, carry: str):
    """Rollouts of the sequence models from their windows, some hundred symbols at a time; ``next`` of the others."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SYMBOLS):
                batch = whole.slice(at, SYMBOLS)
                out = [np.array([v]) for v in batch.column("next").to_pylist()]
                rolled = np.flatnonzero(batch.column("window").is_valid().to_numpy(zero_copy_only=False))
                if len(rolled):
                    cols = [np.array([batch.column(c)[int(i)].values.to_numpy() for i in rolled]) for c in ("coef", "window", "scale_min", "scale_max")]
                    for i, v in zip(rolled, sequence.rollouts(*cols, h, carry)):
                        out[i] = v
                yield _answers(batch, out, None, None)
    return run


def forecast_table(models: DataFrame, bars: DataFrame, h: int = MAX_DAYS_AHEAD,
                   carry: str = "roll") -> DataFrame:
    """One row per (model_type, symbol): ``predictions``, ``lower``, ``upper`` arrays
    of length h, the current price and the as-of date (latest bar)."""
    latest = bars.groupBy("symbol").agg(F.max("date").alias("as_of"),
                                        F.max_by("close", "date").alias("current_price"))
    ok = models.where(F.col("error").isNull())
    z = F.lit(trend_seasonal.INTERVAL_Z)

    # arima: run the recursion from the newest bars (fitted coefficients, serving state)
    arm = ok.where(F.col("model_type") == "arima").select(
        "model_type", "symbol", "metrics",
        ar.ar_forecast_expr(F.col("coef"), F.col("state")["serve_last_diffs"],
                            F.element_at(F.col("state")["serve_last_close"], 1), F.lit(h)).alias("predictions"),
        ar.ar_band_expr(F.col("coef"), F.element_at(F.col("state")["sigma"], 1), F.lit(h)).alias("_s"))
    arm = arm.select("model_type", "symbol", "metrics", "predictions",
                     F.zip_with("predictions", "_s", lambda v, s: v - z * s).alias("lower"),
                     F.zip_with("predictions", "_s", lambda v, s: v + z * s).alias("upper"))

    # prophet: evaluate the fitted curve on the h calendar days after the latest bar; few bytes but a thousand
    # draws a day: dealt to all cores after the join, where sizes alone would make it one task
    parts = models.count() // SYMBOLS
    st, first = F.col("state"), lambda k: F.element_at(F.col("state")[k], 1).alias(k)
    pfit = ok.where(F.col("model_type") == "prophet").join(latest.select("symbol", "as_of"), "symbol").select(
        "model_type", "symbol", "metrics", "coef", first("t0"), first("span"), first("y_scale"), first("sigma"), st["knots"].alias("knots"),
        F.unix_date("as_of").cast("double").alias("day"))
    shuffles = int(models.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prm = pfit.repartition(max(parts, shuffles), "symbol").mapInArrow(_curves(h), FORECASTS)

    # lstm: rollout of the one-step sequence regressor from the newest window; linear: the next close from the
    # newest row's features. Both come from one pass over the bars
    lstm, features = F.col("model_type") == "lstm", [F.element_at("features", i + 1).alias(c) for i, c in enumerate(LINEAR_FEATURES)]
    new = ok.where(F.col("model_type").isin("lstm", "linear")).drop("features").join(_newest(bars, parts), "symbol").where(
        F.when(lstm, F.col("window").isNotNull()).otherwise(F.col("features").isNotNull()))
    new = new.select("model_type", "symbol", "metrics", "coef", "intercept", st["scale_min"].alias("scale_min"), st["scale_max"].alias("scale_max"),
                     F.when(lstm, F.col("window")).alias("window"), *features)
    new = new.withColumn("next", F.when(~lstm, linear.linear_predict(LINEAR_FEATURES))).drop("intercept", *LINEAR_FEATURES)

    allfc = arm.unionByName(prm).unionByName(new.mapInArrow(_rollouts(h, carry), FORECASTS))
    return allfc.join(latest, "symbol")


def predict_batch(requests: DataFrame, forecasts: DataFrame, timestamp: str) -> DataFrame:
    """A full response row per request; failures become ``status='error'`` rows."""
    req = validate_requests(requests)
    j = req.join(forecasts, ["symbol", "model_type"], "left")
    h = F.col("days_ahead")
    err = (F.when(F.col("error").isNotNull(), F.col("error"))
           .when(h < 1, F.lit("days_ahead must be positive"))
           .when(F.col("predictions").isNull(),
                 F.concat(F.lit("No models found for "), F.col("symbol"), F.lit(" "), F.col("model_type")))
           .when(h > F.size("predictions"),
                 F.concat(F.col("model_type"), F.lit(" serves days up to "), F.size("predictions").cast("string"))))
    ok = err.isNull()
    return j.select(
        "request_id", "symbol", "model_type", "requested_days", F.when(ok, h).alias("served_days"),
        F.when(ok, F.slice("predictions", 1, h)).alias("predictions"),
        F.when(ok, F.slice("lower", 1, h)).alias("lower_bounds"),
        F.when(ok, F.slice("upper", 1, h)).alias("upper_bounds"),
        F.when(ok, F.col("current_price")).alias("current_price"),
        F.when(ok, prediction_dates(F.col("as_of"), h)).alias("prediction_dates"),
        F.when(ok, confidence(F.col("model_type"))).alias("confidence"),
        F.when(ok, F.col("metrics")).alias("metrics"),
        F.to_timestamp(F.lit(timestamp)).alias("timestamp"),
        F.when(ok, F.lit("success")).otherwise(F.lit("error")).alias("status"),
        err.alias("message"))


def to_json_body(responses: DataFrame) -> DataFrame:
    """response rows → JSON strings (dates and timestamps as text)."""
    return responses.select("request_id", F.to_json(F.struct(*[c for c in responses.columns])).alias("body"))
