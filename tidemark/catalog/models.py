"""Model fit, evaluation and forecast queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import oracle_sql as O
from tidemark.catalog import register
from tidemark.functions.presentation import rounded
from tidemark.models import ar, linear, sequence, trend_seasonal as TS
from tidemark.operators import evaluate as E
from tidemark.operators.cleaning import LINEAR_FEATURES
from tidemark.operators.indicators import add_indicators
from tidemark.plans import predict as P
from tidemark.plans.train import train_all, train_many
from tidemark.session import cut_lineage, stored
from tidemark.sources.bars import bars_from
from tidemark.sources.tables import read_table

R = O.round_all
AS_OF = "2024-01-02 00:00:00"


# ------------------------------------------------------------------ M1 single-feature, baselines, A1/A5/A6
@register("fit_linear_1f", R(f"""SELECT symbol, count(*) AS n_train, regr_slope(target, MA_5) AS slope,
    regr_intercept(target, MA_5) AS intercept FROM ({O.linear_dataset('brands')}) s
  WHERE split = 'train' GROUP BY symbol""", ["slope", "intercept"], ["symbol", "n_train"]))
def q_fit_linear_1f(spark, sf):
    return rounded(linear.fit_linear_1f(linear.linear_dataset(bars_from(spark, sf, "brands"))))


def closes_from(spark: SparkSession, sf: str, source: str) -> DataFrame:
    """The bars as far as models need them. A bar made from ticks has all four prices, so those left
    out never make a row incomplete; they would be two thirds of what is shuffled."""
    return bars_from(spark, sf, source).select("symbol", "date", "close", "volume")


BASELINES = ("persistence", "ma_5", "ma_20", "linear_1f")


def baseline_predictions(ds: DataFrame) -> DataFrame:
    """Test-split predictions of four reference-free baselines: tomorrow's close
    = today's close, MA_5, MA_20, or the single-feature regression on MA_5.

    The regression is a window aggregate of the train rows: the rows are dealt by symbol already,
    where a join of fits and test rows would make the bars twice."""
    w, train = Window.partitionBy("symbol"), F.col("split") == "train"
    x, y = F.when(train, F.col("MA_5")), F.when(train, F.col("target"))
    test = ds.select("*", F.count(F.when(train, F.lit(1))).over(w).alias("n_train"), F.regr_slope(y, x).over(w).alias("slope"),
                     F.regr_intercept(y, x).over(w).alias("intercept"))
    test = test.where(F.col("symbol").isNotNull() & (F.col("split") == "test") & (F.col("n_train") > 0))
    preds = {"persistence": F.col("close"), "ma_5": F.col("MA_5"), "ma_20": F.col("MA_20"),
             "linear_1f": F.col("intercept") + F.col("slope") * F.col("MA_5")}
    # one pass over the test rows: each row yields its four (model, prediction) pairs
    pairs = F.array(*[F.struct(F.lit(n).alias("model_type"), preds[n].cast("double").alias("yhat"))
                      for n in BASELINES])
    return test.select("symbol", "date", F.col("target").alias("y"), F.inline(pairs)).select(
        "symbol", "date", "model_type", "y", "yhat")


def baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    ds = linear.linear_dataset(closes_from(spark, sf, "suppliers"))
    return E.regression_metrics(baseline_predictions(ds), ("symbol", "model_type")).drop("mse")


_BASE_PRED_SQL = f"""WITH s AS ({O.linear_dataset('suppliers')}),
  fit AS (SELECT symbol, regr_slope(target, MA_5) AS slope, regr_intercept(target, MA_5) AS intercept
          FROM s WHERE split = 'train' GROUP BY symbol),
  t AS (SELECT * FROM s JOIN fit USING (symbol) WHERE split = 'test'),
  p AS (SELECT symbol, date, 'persistence' AS model_type, target AS y, close AS yhat FROM t
        UNION ALL SELECT symbol, date, 'ma_5', target, MA_5 FROM t
        UNION ALL SELECT symbol, date, 'ma_20', target, MA_20 FROM t
        UNION ALL SELECT symbol, date, 'linear_1f', target, intercept + slope * MA_5 FROM t)"""
_BASE_METRICS_SQL = f"{_BASE_PRED_SQL}\n{O.metrics('SELECT * FROM p', 'symbol, model_type')}"


@register("baseline_metrics", R(_BASE_METRICS_SQL, ["mae", "rmse", "r2"], ["symbol", "model_type", "n"]))
def q_baseline_metrics(spark, sf):
    return rounded(baseline_metrics(spark, sf))


@register("linear_1f_metrics", R(f"""WITH s AS ({O.linear_dataset('brands')}),
  fit AS (SELECT symbol, regr_slope(target, MA_5) AS slope, regr_intercept(target, MA_5) AS intercept
          FROM s WHERE split = 'train' GROUP BY symbol)
  {O.metrics("SELECT symbol, target AS y, intercept + slope * MA_5 AS yhat FROM s JOIN fit USING (symbol) WHERE split = 'test'")}""",
                                 ["mae", "rmse", "r2"], ["symbol", "n"]))
def q_linear_1f_metrics(spark, sf):
    ds = linear.linear_dataset(bars_from(spark, sf, "brands"))
    fit = linear.fit_linear_1f(ds)
    pred = ds.where(F.col("split") == "test").join(fit, "symbol").select(
        "symbol", F.col("target").alias("y"), (F.col("intercept") + F.col("slope") * F.col("MA_5")).alias("yhat"))
    return rounded(E.regression_metrics(pred, ("symbol",)).drop("mse"))


@register("training_summary", R(f"""{_BASE_PRED_SQL}
  SELECT symbol, mae, r2 FROM ({O.metrics("SELECT * FROM p WHERE model_type = 'linear_1f'", 'symbol')}) m
  WHERE mae IS NOT NULL""", ["mae", "r2"], ["symbol"]))
def q_training_summary(spark, sf):
    m = baseline_metrics(spark, sf).where(F.col("model_type") == "linear_1f")
    return rounded(E.training_summary(m))


@register("rank_models", R(f"""SELECT *, CASE WHEN rank = 1 THEN 'Best' ELSE 'Good' END AS label FROM (
    SELECT symbol, model_type, mae, row_number() OVER (PARTITION BY symbol ORDER BY mae ASC NULLS LAST, model_type) AS rank
    FROM ({_BASE_METRICS_SQL}) m) r""", ["mae"], ["symbol", "model_type", "rank", "label"]))
def q_rank_models(spark, sf):
    m = baseline_metrics(spark, sf).select("symbol", "model_type", "mae")
    return rounded(E.rank_models(m, "mae", partition=("symbol",), ascending=True, tie="model_type"))


@register("rank_symbols", R(f"""SELECT *, CASE WHEN rank = 1 THEN 'Best' ELSE 'Good' END AS label FROM (
    SELECT symbol, mae, r2, CAST(row_number() OVER (ORDER BY round(r2, 6) DESC NULLS LAST, symbol) AS INTEGER) AS rank
    FROM ({_BASE_METRICS_SQL}) m WHERE model_type = 'linear_1f') r""", ["mae", "r2"], ["symbol", "rank", "label"]))
def q_rank_symbols(spark, sf):
    """All symbols ranked by the fit of one model type."""
    m = baseline_metrics(spark, sf).where(F.col("model_type") == "linear_1f").select("symbol", "mae", F.round("r2", 6).alias("r2"))
    return rounded(E.rank_models(m, "r2"))


# ------------------------------------------------------------------ M6 future frame (SQL)
@register("future_frame", f"""WITH s AS (SELECT symbol, date,
      row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn, count(*) OVER (PARTITION BY symbol) AS n
    FROM ({O.bars('orders')}) b WHERE close IS NOT NULL),
  tr AS (SELECT * FROM s WHERE rn <= (n * 4) // 5)
  SELECT symbol, date AS ds FROM tr
  UNION ALL
  SELECT symbol, CAST(unnest(generate_series(last + INTERVAL 1 DAY, last + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE)
  FROM (SELECT symbol, max(date) AS last FROM tr GROUP BY symbol) l""")
def q_future_frame(spark, sf):
    ds = TS.ts_dataset(bars_from(spark, sf, "orders"))
    train = ds.where(F.col("split") == "train")
    last = train.groupBy("symbol").agg(F.max("ds").alias("last_train_date"))
    return TS.future_frame(last, 30, include_history=train)


# ------------------------------------------------------------------ M1 moments and M2 given coefficients (SQL)
_PAIRS = [(a, b) for i, a in enumerate(LINEAR_FEATURES) for b in [*LINEAR_FEATURES[i + 1:], "target"]]


@register("linear_correlations", R(" UNION ALL ".join(
    f"""SELECT symbol, '{a}' AS a, '{b}' AS b, count(*) AS n_train, corr({a}, {b}) AS r
        FROM ({O.linear_dataset('brands')}) s WHERE split = 'train' GROUP BY symbol
        HAVING stddev_pop({a}) > 0 AND stddev_pop({b}) > 0""" for a, b in _PAIRS), ["r"], ["symbol", "a", "b", "n_train"]))
def q_linear_correlations(spark, sf):
    """The second moments the linear fit solves from, as correlations."""
    ds = linear.linear_dataset(bars_from(spark, sf, "brands"))
    mom = linear.moments(ds.where(F.col("split") == "train"))
    at = {c: i for i, c in enumerate([*LINEAR_FEATURES, "target"])}
    rows = F.array(*[F.struct(
        F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{at[a]}_{at[a]}").alias("va"), F.col(f"c{at[b]}_{at[b]}").alias("vb"),
        F.col(f"c{at[a]}_{at[b]}").alias("cab")) for a, b in _PAIRS])
    out = mom.select("symbol", "n_train", F.inline(rows)).where("va > 0 and vb > 0")
    return rounded(out.select("symbol", "a", "b", "n_train", (F.col("cab") / F.sqrt(F.col("va") * F.col("vb"))).alias("r")))


@register("linear_predict_given", R(f"""SELECT symbol, date, 1.5 + 0.25 * MA_5 + 0.5 * MA_20 - 0.125 * RSI + 0.0625 * Volume_MA AS yhat
  FROM ({O.linear_dataset('brands')}) s WHERE split = 'test'""", ["yhat"], ["symbol", "date"]))
def q_linear_predict_given(spark, sf):
    ds = linear.linear_dataset(bars_from(spark, sf, "brands")).where(F.col("split") == "test")
    coef = F.array(*[F.lit(c) for c in (0.25, 0.5, -0.125, 0.0625)])
    return rounded(ds.select("symbol", "date", linear.linear_predict(LINEAR_FEATURES, coef, F.lit(1.5)).alias("yhat")))


# ------------------------------------------------------------------ rows-only fits and forecasts
@register("fit_linear")
def q_fit_linear(spark, sf):
    return linear.fit_linear(linear.linear_dataset(bars_from(spark, sf, "brands")))


@register("linear_metrics")
def q_linear_metrics(spark, sf):
    ds = linear.linear_dataset(bars_from(spark, sf, "brands"))
    return linear.evaluate_linear(ds, linear.fit_linear(ds))


@register("fit_ar")
def q_fit_ar(spark, sf):
    return ar.fit_ar(ar.ar_dataset(bars_from(spark, sf, "brands")))


@register("ar_forecast")
def q_ar_forecast(spark, sf):
    fit = ar.fit_ar(ar.ar_dataset(bars_from(spark, sf, "brands")))
    return fit.where(F.col("error").isNull()).select(
        "symbol", F.posexplode(ar.ar_forecast_expr(F.col("coef"), F.col("last_diffs"), F.col("last_close"),
                                                   F.lit(30))).alias("step", "yhat"))


@register("ar_metrics")
def q_ar_metrics(spark, sf):
    ds = ar.ar_dataset(bars_from(spark, sf, "brands"))
    return ar.evaluate_ar(ds, ar.fit_ar(ds))


@register("fit_trend_seasonal")
def q_fit_ts(spark, sf):
    return TS.fit_trend_seasonal(TS.ts_dataset(bars_from(spark, sf, "brands")))


@register("forecast_trend_seasonal")
def q_forecast_ts(spark, sf):
    fit = TS.fit_trend_seasonal(TS.ts_dataset(bars_from(spark, sf, "brands")))
    return TS.forecast_frame(fit, TS.future_frame(fit, 30))


@register("trend_seasonal_metrics")
def q_ts_metrics(spark, sf):
    ds = TS.ts_dataset(bars_from(spark, sf, "brands"))
    return TS.evaluate_trend_seasonal(ds, TS.fit_trend_seasonal(ds))


@register("trend_seasonal_metrics_positional")
def q_ts_metrics_positional(spark, sf):
    ds = TS.ts_dataset(bars_from(spark, sf, "brands"))
    return TS.evaluate_trend_seasonal(ds, TS.fit_trend_seasonal(ds), align="position")


@register("sequence_metrics")
def q_sequence_metrics(spark, sf):
    ds = sequence.sequence_dataset(add_indicators(bars_from(spark, sf, "orders")))
    return sequence.evaluate_sequence(ds, sequence.fit_sequence(ds))


def _rollout(spark, sf, carry):
    ind = add_indicators(bars_from(spark, sf, "orders"))
    ds = sequence.sequence_dataset(ind)
    return sequence.predict_sequence(sequence.fit_sequence(ds), sequence.latest_window(ind, sequence.scalers(ds)), 30, carry)


@register("sequence_rollout")
def q_sequence_rollout(spark, sf):
    return _rollout(spark, sf, "roll")


@register("sequence_rollout_last")
def q_sequence_rollout_last(spark, sf):
    return _rollout(spark, sf, "last")


@register("train_all")
def q_train_all(spark, sf):
    return train_many(bars_from(spark, sf, "orders"), created_at=AS_OF)


def order_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction requests derived from ``orders`` (model type from the order
    status, horizon from the day of month) and from ``events`` (event types
    have no models, so these answer with error rows)."""
    o = read_table(spark, sf, "orders")
    mt = F.when(F.col("o_orderstatus") == "F", "LSTM").when(F.col("o_orderstatus") == "O", "prophet") \
        .otherwise("ARIMA")
    a = o.select(F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("request_id"),
                 F.lower("o_orderpriority").alias("symbol"), mt.alias("model_type"),
                 F.dayofmonth("o_orderdate").alias("days_ahead"))
    e = read_table(spark, sf, "events").select(
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("event_type").alias("symbol"), F.lit("lstm").alias("model_type"),
        F.floor(F.col("value") / 10).cast("int").alias("days_ahead"))
    return a.unionByName(e)


def responses(spark: SparkSession, sf: str) -> DataFrame:
    bars = stored(closes_from(spark, sf, "orders"))  # read by the fits and by serving
    # stored, so that the planner knows its size: few symbols are sent to the requests, which would else be
    # dealt by symbol and model type to as many tasks as there are pairs
    fc = stored(P.forecast_table(train_many(bars, created_at=AS_OF, is_stored=True), bars))
    return P.predict_batch(order_requests(spark, sf), fc, AS_OF)


@register("predict_batch")
def q_predict_batch(spark, sf):
    return responses(spark, sf)


@register("predict_responses", R(f"""WITH b AS ({O.bars('orders')}),
  l AS (SELECT symbol, max(date) AS as_of, arg_max(close, date) AS price FROM b GROUP BY symbol),
  q AS (SELECT 'ord-' || o_orderkey AS request_id, upper(o_orderpriority) AS symbol,
          CASE o_orderstatus WHEN 'F' THEN 'lstm' WHEN 'O' THEN 'prophet' ELSE 'arima' END AS model_type,
          CAST(day(o_orderdate) AS INTEGER) AS requested_days FROM orders
        UNION ALL SELECT 'evt-' || event_id, upper(event_type), 'lstm', CAST(floor(value / 10) AS INTEGER) FROM events),
  r AS (SELECT q.*, l.as_of, l.price, least(coalesce(requested_days, 1), 30) AS h,
          CASE WHEN least(coalesce(requested_days, 1), 30) < 1 THEN 'days_ahead must be positive'
               WHEN l.symbol IS NULL THEN 'No models found for ' || q.symbol || ' ' || model_type END AS message
        FROM q LEFT JOIN l ON l.symbol = q.symbol)
  SELECT request_id, symbol, model_type, requested_days, CASE WHEN message IS NULL THEN h END AS served_days,
    CASE WHEN message IS NULL THEN price END AS current_price,
    CASE WHEN message IS NULL THEN strftime(as_of + 1, '%Y-%m-%d') END AS first_date,
    CASE WHEN message IS NULL THEN strftime(as_of + h, '%Y-%m-%d') END AS last_date,
    CASE WHEN message IS NULL THEN CASE model_type WHEN 'lstm' THEN 'medium' WHEN 'prophet' THEN 'high' END END AS confidence,
    CASE WHEN message IS NULL THEN 'success' ELSE 'error' END AS status, message FROM r""",
                                 ["current_price"], ["request_id", "symbol", "model_type", "requested_days", "served_days", "first_date",
                                                     "last_date", "confidence", "status", "message"]))
def q_predict_responses(spark, sf):
    """Everything of the responses but the predicted values."""
    r = responses(spark, sf)
    date = lambda i: F.date_format(F.element_at("prediction_dates", i), "yyyy-MM-dd")
    return rounded(r.select("request_id", "symbol", "model_type", "requested_days", "served_days", "current_price", date(1).alias("first_date"),
                            date(-1).alias("last_date"), "confidence", "status", "message"))


@register("predict_json", """SELECT 'ord-' || o_orderkey AS request_id FROM orders UNION ALL SELECT 'evt-' || event_id FROM events""")
def q_predict_json(spark, sf):
    """every response as a JSON body that reads back."""
    body = P.to_json_body(responses(spark, sf))
    return body.select(F.get_json_object("body", "$.request_id").alias("request_id"))


_BODY = {"request_id": "string", "symbol": "string", "model_type": "string", "requested_days": "int", "served_days": "int",
         "current_price": "double", "confidence": "string", "timestamp": "string", "status": "string", "message": "string"}


@register("predict_json_fields", R(f"""WITH b AS ({O.bars('orders')}),
  l AS (SELECT symbol, max(date) AS as_of, arg_max(close, date) AS price FROM b GROUP BY symbol),
  q AS (SELECT 'ord-' || o_orderkey AS request_id, upper(o_orderpriority) AS symbol,
          CASE o_orderstatus WHEN 'F' THEN 'lstm' WHEN 'O' THEN 'prophet' ELSE 'arima' END AS model_type,
          CAST(day(o_orderdate) AS INTEGER) AS requested_days FROM orders
        UNION ALL SELECT 'evt-' || event_id, upper(event_type), 'lstm', CAST(floor(value / 10) AS INTEGER) FROM events),
  r AS (SELECT q.*, l.as_of, l.price, least(coalesce(requested_days, 1), 30) AS h,
          CASE WHEN least(coalesce(requested_days, 1), 30) < 1 THEN 'days_ahead must be positive'
               WHEN l.symbol IS NULL THEN 'No models found for ' || q.symbol || ' ' || model_type END AS message
        FROM q LEFT JOIN l ON l.symbol = q.symbol)
  SELECT request_id, symbol, model_type, requested_days, CASE WHEN message IS NULL THEN h END AS served_days,
    CASE WHEN message IS NULL THEN price END AS current_price, '2024-01-02T00:00:00.000Z' AS timestamp,
    CASE WHEN message IS NULL THEN h END AS n_predictions,
    CASE WHEN message IS NULL AND model_type <> 'lstm' THEN h END AS n_bounds,
    CASE WHEN message IS NULL THEN strftime(as_of + 1, '%Y-%m-%d') END AS first_date,
    CASE WHEN message IS NULL THEN strftime(as_of + h, '%Y-%m-%d') END AS last_date,
    CASE WHEN message IS NULL THEN 4 END AS n_metrics, CASE WHEN message IS NULL THEN true END AS bounds_hold,
    CASE WHEN message IS NULL THEN CASE model_type WHEN 'lstm' THEN 'medium' WHEN 'prophet' THEN 'high' END END AS confidence,
    CASE WHEN message IS NULL THEN 'success' ELSE 'error' END AS status, message FROM r""",
                                   ["current_price"], ["request_id", "symbol", "model_type", "requested_days", "served_days", "timestamp",
                                                       "n_predictions", "n_bounds", "first_date", "last_date", "n_metrics", "bounds_hold",
                                                       "confidence", "status", "message"]))
def q_predict_json_fields(spark, sf):
    """every field of the JSON bodies, read back; of the predicted values their number and
    that they lie inside their bounds."""
    schema = ", ".join(f"{k} {v}" for k, v in _BODY.items())
    schema += ", predictions array<double>, lower_bounds array<double>, upper_bounds array<double>, prediction_dates array<string>, metrics map<string,double>"
    b = P.to_json_body(responses(spark, sf)).select(F.from_json("body", schema).alias("b")).select("b.*")
    some = lambda c: F.when(F.size(c) >= 0, F.size(c))
    inside = F.zip_with(F.zip_with("lower_bounds", "predictions", lambda a, y: a <= y), F.zip_with("predictions", "upper_bounds", lambda y, c: y <= c),
                        lambda a, c: a & c)
    hold = F.when(F.col("status") == "success", F.coalesce(F.forall(inside, lambda x: x), F.lit(True)))
    return rounded(b.select(*_BODY, some("predictions").alias("n_predictions"), some("upper_bounds").alias("n_bounds"),
                            F.element_at("prediction_dates", 1).alias("first_date"), F.element_at("prediction_dates", -1).alias("last_date"),
                            some("metrics").alias("n_metrics"), hold.alias("bounds_hold")))


# ------------------------------------------------------------------ M8-M11 with a model per supplier
def _supplier_models(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    bars = stored(closes_from(spark, sf, "suppliers"))
    return bars, train_many(bars, created_at=AS_OF, is_stored=True)


@register("train_suppliers", f"""SELECT t.model_type, b.symbol, true AS fitted, 4 AS n_metrics
  FROM (SELECT DISTINCT symbol FROM ({O.bars('suppliers')}) x) b, (VALUES ('linear'), ('arima'), ('prophet'), ('lstm')) t(model_type)""")
def q_train_suppliers(spark, sf):
    """All four model types for every supplier."""
    return _supplier_models(spark, sf)[1].select(
        "model_type", "symbol", (F.col("error").isNull() & F.col("coef").isNotNull()).alias("fitted"), F.size("metrics").alias("n_metrics"))


@register("predict_suppliers", R(f"""WITH l AS (SELECT symbol, max(date) AS as_of, arg_max(close, date) AS price FROM ({O.bars('suppliers')}) b GROUP BY symbol),
  q AS (SELECT t.m || '-' || s_suppkey AS request_id, CAST(s_suppkey AS VARCHAR) AS symbol, t.m AS model_type,
          CASE WHEN t.m = 'linear' THEN 1 ELSE CAST(s_suppkey % 30 + 1 AS INTEGER) END AS requested_days
        FROM supplier, (VALUES ('linear'), ('arima'), ('prophet'), ('lstm')) t(m))
  SELECT request_id, q.symbol, model_type, CASE WHEN l.symbol IS NOT NULL THEN requested_days END AS served_days,
    CASE WHEN l.symbol IS NOT NULL THEN requested_days END AS n_predictions, price AS current_price,
    strftime(as_of + requested_days, '%Y-%m-%d') AS last_date, CASE WHEN l.symbol IS NULL THEN 'error' ELSE 'success' END AS status
  FROM q LEFT JOIN l ON l.symbol = q.symbol""", ["current_price"], ["request_id", "symbol", "model_type", "served_days", "n_predictions", "last_date", "status"]))
def q_predict_suppliers(spark, sf):
    """Requests for every supplier and model type, answered from the suppliers' own models."""
    bars, models = _supplier_models(spark, sf)
    types = F.explode(F.array(*[F.lit(t) for t in ("linear", "arima", "prophet", "lstm")])).alias("model_type")
    asked = read_table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"), "s_suppkey", types).select(
        F.concat_ws("-", "model_type", "symbol").alias("request_id"), "symbol", "model_type",
        F.when(F.col("model_type") == "linear", F.lit(1)).otherwise((F.col("s_suppkey") % 30 + 1).cast("int")).alias("days_ahead"))
    r = P.predict_batch(asked, P.forecast_table(models, bars), AS_OF)
    return rounded(r.select("request_id", "symbol", "model_type", "served_days", F.when(F.col("predictions").isNotNull(), F.size("predictions")).alias("n_predictions"),
                            "current_price", F.date_format(F.element_at("prediction_dates", -1), "yyyy-MM-dd").alias("last_date"), "status"))


@register("predict_linear_values", R(f"""WITH f AS (SELECT symbol, date, close, avg(close) OVER w5 AS MA_5, avg(close) OVER w20 AS MA_20, avg(volume) OVER w20 AS Volume_MA,
      row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS back
    FROM ({O.bars('suppliers')}) b
    WINDOW w5 AS (PARTITION BY symbol ORDER BY date ROWS 4 PRECEDING), w20 AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING))
  SELECT 'next-' || symbol AS request_id, symbol, 1.5 + 0.25 * MA_5 + 0.5 * MA_20 - 0.125 * 50 + 0.0625 * Volume_MA AS prediction
  FROM f WHERE back = 1 AND rn >= 20""", ["prediction"], ["request_id", "symbol"]))
def q_predict_linear_values(spark, sf):
    """The predicted values of linear models with given coefficients, through the serving plan."""
    bars = cut_lineage(bars_from(spark, sf, "suppliers"))
    models = bars.select("symbol").distinct().select(
        F.lit("linear").alias("model_type"), "symbol", F.array(*[F.lit(c) for c in (0.25, 0.5, -0.125, 0.0625)]).alias("coef"),
        F.lit(1.5).alias("intercept"), F.create_map().cast("map<string,double>").alias("metrics"),
        F.create_map().cast("map<string,array<double>>").alias("state"), F.lit(None).cast("string").alias("error"))
    asked = models.select(F.concat(F.lit("next-"), "symbol").alias("request_id"), "symbol", "model_type", F.lit(1).alias("days_ahead"))
    r = P.predict_batch(asked, P.forecast_table(models, bars), AS_OF).where(F.col("status") == "success")
    return rounded(r.select("request_id", "symbol", F.element_at("predictions", 1).alias("prediction")))
