"""Cleaning, dataset preparation and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import oracle_sql as O
from tidemark.catalog import register
from tidemark.functions.presentation import rounded
from tidemark.operators import cleaning as C
from tidemark.operators import dataset as D
from tidemark.operators import evaluate as E
from tidemark.operators import indicators as I
from tidemark.plans.ingest import ingest
from tidemark.sources.bars import bars_from
from tidemark.sources.snapshots import read_latest_snapshot, shared_path
from tidemark.sources.tables import read_table

SEQ = C.SEQUENCE_FEATURES
R = O.round_all


def indicator_bars(spark: SparkSession, sf: str, source: str = "orders") -> DataFrame:
    return I.add_indicators(bars_from(spark, sf, source))


def seq_complete(spark: SparkSession, sf: str) -> DataFrame:
    return C.drop_incomplete(C.select_features(indicator_bars(spark, sf), SEQ))


# ------------------------------------------------------------------ P1-P4
@register("select_features", R(O.seq_features(complete=False), SEQ, ["symbol", "date"]))
def q_select_features(spark, sf):
    return rounded(C.select_features(indicator_bars(spark, sf), SEQ))


@register("drop_incomplete", R(O.seq_features(complete=True), SEQ, ["symbol", "date"]))
def q_drop_incomplete(spark, sf):
    return rounded(seq_complete(spark, sf))


@register("to_ds_y", R(f"SELECT symbol, date AS ds, close AS y FROM ({O.bars('orders')}) b",
                       ["y"], ["symbol", "ds"]))
def q_to_ds_y(spark, sf):
    return rounded(C.to_ds_y(bars_from(spark, sf, "orders")))


_PREFIX = ["MA_5", "MA_20", "MA_50", "RSI", "BB_Middle", "BB_Upper", "BB_Lower"]


@register("select_by_prefix", R(f"SELECT symbol, date, {', '.join(_PREFIX)} FROM ({O.indicators(f'({O.bars()})')}) i",
                                _PREFIX, ["symbol", "date"]))
def q_select_by_prefix(spark, sf):
    return rounded(C.select_by_prefix(indicator_bars(spark, sf)))


# ------------------------------------------------------------------ P5 quarantine
def _supplier_quarantine(spark, sf):
    """Supplier bars, their bars before 1993 once more, and events as bars of no supplier whose
    high is below their low and whose close is often negative."""
    universe = read_table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"))
    bars = bars_from(spark, sf, "suppliers")
    bars = bars.unionByName(bars.where(F.col("date") < F.lit("1993-01-01").cast("date"))).unionByName(_event_bars(spark, sf))
    return C.quarantine(bars, universe)


def _event_bars(spark, sf):
    low = F.col("value") - 50
    return read_table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"), low.alias("open"), low.alias("high"),
        F.col("value").alias("low"), low.alias("close"), F.lit(1).cast("long").alias("volume"))


_EVENT_BARS = """SELECT event_type AS symbol, CAST(ts AS DATE) AS date, value - 50 AS open, value - 50 AS high,
    value AS low, value - 50 AS close, CAST(1 AS BIGINT) AS volume FROM events"""
_QSQL = f"""WITH s AS ({O.bars('suppliers')}),
  b AS (SELECT * FROM s UNION ALL SELECT * FROM s WHERE date < DATE '1993-01-01' UNION ALL {_EVENT_BARS}),
  u AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS s FROM supplier),
  f AS (SELECT b.*, u.s,
          lag(date) OVER (PARTITION BY symbol ORDER BY date) AS pd,
          lead(date) OVER (PARTITION BY symbol ORDER BY date) AS nd
        FROM b LEFT JOIN u ON b.symbol = u.s)"""


@register("quarantine_rejected", f"""{_QSQL}
  SELECT symbol, date, 'non_positive_price' AS reason FROM f WHERE close IS NULL OR close <= 0
  UNION ALL SELECT symbol, date, 'high_below_low' FROM f WHERE high < low
  UNION ALL SELECT symbol, date, 'duplicate_bar' FROM f WHERE pd = date OR nd = date
  UNION ALL SELECT symbol, date, 'unknown_symbol' FROM f WHERE s IS NULL""")
def q_quarantine_rejected(spark, sf):
    return _supplier_quarantine(spark, sf)[1]


@register("quarantine_good", f"""{_QSQL}
  SELECT symbol, count(*) AS good_bars FROM f
  WHERE NOT (close IS NULL OR close <= 0) AND NOT coalesce(high < low, false)
    AND NOT coalesce(pd = date OR nd = date, false) AND s IS NOT NULL
  GROUP BY symbol""")
def q_quarantine_good(spark, sf):
    good = _supplier_quarantine(spark, sf)[0]
    return good.groupBy("symbol").agg(F.count(F.lit(1)).alias("good_bars"))


_IND = ["open", "high", "low", "close", "MA_5", "MA_20", "MA_50", "RSI", "BB_Middle", "BB_Upper", "BB_Lower", "Volume_MA"]


@register("ingest_plan", R(O.indicators(f"({O.bars('orders')})"), _IND, ["symbol", "date", "volume"]))
def q_ingest_plan(spark, sf):
    """E1 over order bars and event bars: all event bars are rejected, the others are stored."""
    root = shared_path(spark, "ingest")
    universe = read_table(spark, sf, "orders").select(F.col("o_orderpriority").alias("symbol"))
    bars = bars_from(spark, sf, "orders").unionByName(_event_bars(spark, sf))
    ingest(bars, root, "20240101_090000", universe)
    schema = I.add_indicators(bars).schema
    return rounded(read_latest_snapshot(spark, root, schema)[0].select("symbol", "date", "volume", *_IND))


# ------------------------------------------------------------------ P6-P7 requests
def event_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction requests derived from ``events``: symbol from the event type
    (lower case), model type from the ``k`` property, horizon from the value."""
    e = read_table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    mt = (F.when(k < 30, "LSTM").when(k < 60, "Prophet").when(k < 85, "arima")
          .when(k < 95, F.lit(None).cast("string")).otherwise("xgboost"))
    return e.select("event_id", F.lower("event_type").alias("symbol"), mt.alias("model_type"),
                    F.floor(F.col("value") / 5).cast("int").alias("days_ahead"))


_REQ_SQL = """SELECT event_id, lower(event_type) AS symbol,
    CASE WHEN k < 30 THEN 'LSTM' WHEN k < 60 THEN 'Prophet' WHEN k < 85 THEN 'arima'
         WHEN k < 95 THEN NULL ELSE 'xgboost' END AS model_type,
    CAST(floor(value / 5) AS INTEGER) AS days_ahead
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e"""

_VALID_SQL = """SELECT event_id, upper(coalesce(symbol, 'AAPL')) AS symbol,
    lower(coalesce(model_type, 'lstm')) AS model_type,
    days_ahead AS requested_days, least(coalesce(days_ahead, 1), 30) AS days_ahead,
    CASE WHEN lower(coalesce(model_type, 'lstm')) NOT IN ('lstm', 'prophet', 'arima', 'linear')
         THEN 'Unsupported model type: ' || lower(coalesce(model_type, 'lstm')) END AS error
  FROM ({src}) r"""


@register("validate_requests", _VALID_SQL.format(src=_REQ_SQL))
def q_validate_requests(spark, sf):
    return C.validate_requests(event_requests(spark, sf))


@register("parse_request_body", _VALID_SQL.format(src="""SELECT event_id,
    json_extract_string(body, '$.symbol') AS symbol, json_extract_string(body, '$.model_type') AS model_type,
    CAST(json_extract_string(body, '$.days_ahead') AS INTEGER) AS days_ahead
  FROM (SELECT event_id, '{"symbol": "' || event_type || '", "days_ahead": '
          || CAST(CAST(floor(value / 5) AS INTEGER) AS VARCHAR) || '}' AS body FROM events) b"""))
def q_parse_request_body(spark, sf):
    e = read_table(spark, sf, "events")
    body = F.concat(F.lit('{"symbol": "'), F.col("event_type"), F.lit('", "days_ahead": '),
                    F.floor(F.col("value") / 5).cast("int").cast("string"), F.lit("}"))
    return C.validate_requests(C.parse_request_body(e.select("event_id", body.alias("body"))))


# ------------------------------------------------------------------ W2/W3, W6/W7, W9, W10
@register("diff_gain_loss", R(f"""SELECT symbol, date, close - lag(close) OVER w AS delta,
    CASE WHEN close - lag(close) OVER w > 0 THEN close - lag(close) OVER w ELSE 0.0 END AS gain,
    CASE WHEN close - lag(close) OVER w < 0 THEN lag(close) OVER w - close ELSE 0.0 END AS loss
  FROM ({O.bars('brands')}) b WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
                              ["delta", "gain", "loss"], ["symbol", "date"]))
def q_diff_gain_loss(spark, sf):
    b = bars_from(spark, sf, "brands")
    w = I.symbol_window()
    d = I.diff("close", w)
    g, l = I.gain_loss(d)
    return rounded(b.select("symbol", "date", d.alias("delta"), g.alias("gain"), l.alias("loss")))


_SIMPLE = ["open", "high", "low", "close", "MA_5", "MA_20", "RSI", "Volume_MA", "BB_Upper", "BB_Lower"]


@register("simple_features", R(O.simple_features("brands"), _SIMPLE, ["symbol", "date", "volume"]))
def q_simple_features(spark, sf):
    return rounded(C.drop_incomplete(I.simple_features(bars_from(spark, sf, "brands"))))


_TARGET_SQL = R(f"""SELECT * FROM (SELECT symbol, date, close,
    lead(close) OVER (PARTITION BY symbol ORDER BY date) AS target FROM ({O.bars('brands')}) b) t
  WHERE target IS NOT NULL""", ["close", "target"], ["symbol", "date"])


@register("next_target", _TARGET_SQL)
def q_next_target(spark, sf):
    return rounded(I.next_target(bars_from(spark, sf, "brands").select("symbol", "date", "close")))


@register("next_target_blocked", _TARGET_SQL)
def q_next_target_blocked(spark, sf):
    return rounded(I.next_target(bars_from(spark, sf, "brands").select("symbol", "date", "close"), block_rows=64))


@register("latest_close", R(f"""SELECT symbol, max(date) AS as_of, arg_max(close, date) AS last_close
  FROM ({O.bars('suppliers')}) b GROUP BY symbol""", ["last_close"], ["symbol", "as_of"]))
def q_latest_close(spark, sf):
    return rounded(I.latest_row(bars_from(spark, sf, "suppliers")))


# ------------------------------------------------------------------ W11-W13, A2, F1-F2
_SCALED = "SELECT symbol, date, " + ", ".join(
    f"CASE WHEN max({c}) OVER s > min({c}) OVER s THEN ({c} - min({c}) OVER s) / (max({c}) OVER s - min({c}) OVER s) ELSE 0.0 END AS {c}"
    for c in SEQ) + f" FROM ({O.seq_features()}) f WINDOW s AS (PARTITION BY symbol)"
_ROWSUM = " + ".join(SEQ)


_LOOKBACK_SQL = R(f"""SELECT * FROM (SELECT symbol, date,
    count(*) OVER lb AS seq_len, lag(close, 60) OVER w AS x_first_close,
    lag(close, 1) OVER w AS x_last_close, sum({_ROWSUM}) OVER lb AS x_sum, close AS y
  FROM ({_SCALED}) s
  WINDOW w AS (PARTITION BY symbol ORDER BY date),
         lb AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)) q
  WHERE seq_len = 60""", ["x_first_close", "x_last_close", "x_sum", "y"], ["symbol", "date", "seq_len"])


@register("lookback_sequences", _LOOKBACK_SQL)
def q_lookback_sequences(spark, sf):
    return _sequences(spark, sf, None)


@register("lookback_sequences_blocked", _LOOKBACK_SQL)
def q_lookback_sequences_blocked(spark, sf):
    return _sequences(spark, sf, 64)


def _sequences(spark, sf, block_rows):
    seq = D.lookback_sequences(D.scale_features(seq_complete(spark, sf), SEQ), SEQ, block_rows=block_rows)
    total = F.aggregate("x", F.lit(0.0), lambda acc, s: acc + (
        s.close + s.volume + s.MA_5 + s.MA_20 + s.RSI + s.BB_Upper + s.BB_Lower))
    return rounded(seq.select("symbol", "date", F.size("x").cast("long").alias("seq_len"),
                              F.col("x")[0]["close"].alias("x_first_close"),
                              F.col("x")[59]["close"].alias("x_last_close"),
                              total.alias("x_sum"), "y"))


_SPLIT_SQL = f"""SELECT symbol, split, count(*) AS rows, min(date) AS first_date,
    max(date) AS last_date FROM (SELECT symbol, date,
      CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY date) <= (count(*) OVER (PARTITION BY symbol) * 4) // 5
           THEN 'train' ELSE 'test' END AS split FROM ({O.seq_features()}) f) s GROUP BY symbol, split"""


@register("chronological_split", _SPLIT_SQL)
def q_chronological_split(spark, sf):
    return _split_rows(D.chronological_split(seq_complete(spark, sf)))


@register("chronological_split_blocked", _SPLIT_SQL)
def q_chronological_split_blocked(spark, sf):
    return _split_rows(D.chronological_split(seq_complete(spark, sf), blocked=True))


def _split_rows(s):
    return s.groupBy("symbol", "split").agg(F.count(F.lit(1)).alias("rows"),
                                            F.min("date").alias("first_date"),
                                            F.max("date").alias("last_date"))


@register("tail_5", R(f"""SELECT * EXCLUDE (_rn, _cnt) FROM (SELECT *,
    row_number() OVER (PARTITION BY symbol ORDER BY date) AS _rn, count(*) OVER (PARTITION BY symbol) AS _cnt
  FROM ({O.seq_features()}) f) t WHERE _rn > _cnt - 5""", SEQ, ["symbol", "date"]))
def q_tail_5(spark, sf):
    return rounded(D.tail_n(seq_complete(spark, sf), 5))


def _minmax_sql(train_only: bool) -> str:
    src = O.seq_features()
    if train_only:
        src = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS _rn,
            count(*) OVER (PARTITION BY symbol) AS _n FROM ({src}) a) b WHERE _rn <= (_n * 4) // 5"""
    parts = [f"SELECT symbol, '{c}' AS feature, min({c}) AS min, max({c}) AS max FROM ({src}) s GROUP BY symbol"
             for c in SEQ]
    return R(" UNION ALL ".join(parts), ["min", "max"], ["symbol", "feature"])


@register("minmax_fit_all", _minmax_sql(False))
def q_minmax_all(spark, sf):
    return rounded(D.minmax_fit(seq_complete(spark, sf), SEQ, "all"))


@register("minmax_fit_train", _minmax_sql(True))
def q_minmax_train(spark, sf):
    return rounded(D.minmax_fit(seq_complete(spark, sf), SEQ, "train"))


@register("minmax_roundtrip", R(f"""SELECT symbol, date, close,
    CASE WHEN hi > lo THEN (close - lo) / (hi - lo) ELSE 0.0 END AS close_scaled,
    (CASE WHEN hi > lo THEN (close - lo) / (hi - lo) ELSE 0.0 END) * (hi - lo) + lo AS close_back
  FROM (SELECT symbol, date, close, min(close) OVER (PARTITION BY symbol) AS lo,
               max(close) OVER (PARTITION BY symbol) AS hi FROM ({O.bars('brands')}) b) s""",
                                ["close", "close_scaled", "close_back"], ["symbol", "date"]))
def q_minmax_roundtrip(spark, sf):
    b = bars_from(spark, sf, "brands").select("symbol", "date", "close")
    s = D.scale_features(b, ["close"]).withColumnRenamed("close", "close_scaled")
    back = D.minmax_inverse(F.col("close_scaled"), F.col("close_min"), F.col("close_max"))
    orig = b.select("symbol", "date", "close")
    out = s.join(orig, ["symbol", "date"]).select("symbol", "date", "close", "close_scaled",
                                                  back.alias("close_back"))
    return rounded(out)


# ------------------------------------------------------------------ A3, A4, A8
@register("dataset_profile", f"""SELECT symbol, count(*) AS data_rows, 7 AS data_columns,
    strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') AS date_range
  FROM ({O.seq_features()}) f GROUP BY symbol""")
def q_dataset_profile(spark, sf):
    return E.dataset_profile(seq_complete(spark, sf))


@register("price_summary", R(f"""SELECT symbol, min(close) AS min_price, max(close) AS max_price,
    stddev_samp(close) AS volatility, count(*) AS n FROM ({O.bars('brands')}) b GROUP BY symbol""",
                             ["min_price", "max_price", "volatility"], ["symbol", "n"]))
def q_price_summary(spark, sf):
    return rounded(E.price_summary(bars_from(spark, sf, "brands")))


@register("collect_stats", f"""SELECT count(DISTINCT symbol) AS symbols,
    'Successfully processed ' || CAST(count(DISTINCT symbol) AS VARCHAR) || ' symbols' AS message,
    200 AS status_code FROM ({O.bars('suppliers')}) b""")
def q_collect_stats(spark, sf):
    return E.collect_stats(bars_from(spark, sf, "suppliers"))
