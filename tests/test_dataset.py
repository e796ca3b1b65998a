import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL, series
from tidemark.operators import cleaning as C
from tidemark.operators import dataset as D
from tidemark.operators.indicators import add_indicators
from tidemark.sources.bars import bars_from, ticks_to_bars


def test_split_is_chronological(spark):
    s = D.chronological_split(bars_from(spark, SF_MID, "orders"))
    agg = s.groupBy("symbol").agg(F.max(F.when(F.col("split") == "train", F.col("date"))).alias("tr"),
                                  F.min(F.when(F.col("split") == "test", F.col("date"))).alias("te"),
                                  F.sum((F.col("split") == "train").cast("int")).alias("ntr"),
                                  F.count(F.lit(1)).alias("n"))
    for r in agg.collect():
        assert r.tr < r.te
        assert r.ntr == int(r.n * 0.8)


@pytest.mark.parametrize("n,expected", [(60 + 19, 0), (80, 1), (100, 21)])
def test_lookback_sample_counts(spark, n, expected):
    # 19 warm-up rows are dropped by P2, then n-19-60 samples remain
    ind = add_indicators(series(spark, [100.0 + (i % 7) for i in range(n)]))
    base = C.drop_incomplete(C.select_features(ind, C.SEQUENCE_FEATURES))
    seq = D.lookback_sequences(D.scale_features(base), C.SEQUENCE_FEATURES)
    assert seq.count() == max(n - 19 - 60, 0)


def test_scale_roundtrip_and_constant(spark):
    b = series(spark, [5.0] * 10, "FLAT").unionByName(series(spark, [1.0 + i for i in range(10)], "UP"))
    s = D.scale_features(b.select("symbol", "date", "close"), ["close"])
    rows = s.select("symbol", "close", D.minmax_inverse(F.col("close"), F.col("close_min"),
                                                        F.col("close_max")).alias("back")).collect()
    assert all(r.close == 0.0 for r in rows if r.symbol == "FLAT")
    up = sorted(r.close for r in rows if r.symbol == "UP")
    assert up[0] == 0.0 and up[-1] == 1.0
    assert all(r.back == pytest.approx(1.0 + 9 * r.close) for r in rows if r.symbol == "UP")


def test_quarantine_and_requests(spark):
    b = series(spark, [10.0, -1.0, 12.0], "BAD").unionByName(series(spark, [1.0, 2.0], "OK"))
    universe = spark.createDataFrame([("OK",)], "symbol string")
    good, rejected = C.quarantine(b, universe)
    reasons = {(r.symbol, r.reason) for r in rejected.collect()}
    assert ("BAD", "non_positive_price") in reasons and ("BAD", "unknown_symbol") in reasons
    assert {r.symbol for r in good.collect()} == {"OK"}
    req = spark.createDataFrame([("aapl", "LSTM", 5), (None, None, None), ("msft", "lstm", 45),
                                 ("goog", "xgboost", 1)], "symbol string, model_type string, days_ahead int")
    out = [r.asDict() for r in C.validate_requests(req).collect()]
    assert out[0] == {"symbol": "AAPL", "model_type": "lstm", "requested_days": 5, "days_ahead": 5, "error": None}
    assert out[1]["symbol"] == "AAPL" and out[1]["model_type"] == "lstm" and out[1]["days_ahead"] == 1
    assert out[2]["days_ahead"] == 30 and out[2]["requested_days"] == 45
    assert out[3]["error"] == "Unsupported model type: xgboost"


def test_bodies_malformed_missing_and_parsed(spark):
    rows = [(1, '{"symbol": "msft", "days_ahead": 3}'), (2, "{not json"), (3, "[]"), (4, None), (5, '{"days_ahead": "x"}'), (6, "{}")]
    df = spark.createDataFrame(rows, "request_id int, body string")
    got = {r.request_id: r for r in C.validate_requests(C.parse_request_body(df)).collect()}
    assert (got[1].symbol, got[1].days_ahead, got[1].error) == ("MSFT", 3, None)
    assert all(got[i].error == "Malformed request body" and got[i].symbol is None for i in (2, 3, 5))
    assert (got[4].symbol, got[4].error, got[6].symbol, got[6].error) == ("AAPL", None, "AAPL", None)
    parsed = spark.createDataFrame([(1, ("goog", "arima", 2))], "request_id int, body struct<symbol:string,model_type:string,days_ahead:int>")
    r = C.validate_requests(C.parse_request_body(parsed)).first()
    assert (r.symbol, r.model_type, r.days_ahead, r.error) == ("GOOG", "arima", 2, None)


def test_not_a_number_is_no_price(spark):
    from tidemark.sources.bars import ticks_to_bars
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    ticks = spark.createDataFrame([("A", t, 1, 0, float("nan"), 1.0), ("A", t, 2, 0, 5.0, 1.0), ("B", t, 1, 0, float("nan"), 1.0)],
                                  "symbol string, ts timestamp_ntz, tick_id long, seq long, price double, qty double")
    assert [(r.symbol, r.open, r.high) for r in ticks_to_bars(ticks).collect()] == [("A", 5.0, 5.0)]
    bad = series(spark, [float("nan"), 2.0], "N")
    good, rejected = C.quarantine(bad)
    assert [r.reason for r in rejected.collect()] == ["non_positive_price"] and good.count() == 1


def test_bars_by_fixed_width_order_key(spark):
    """The hash-aggregated form equals the sorted one, also for negative ids and times within a day."""
    from tidemark.sources.tables import TICK_SOURCES, UNIQUE_TICKS
    for source in UNIQUE_TICKS:
        ticks = TICK_SOURCES[source](spark, SF_SMALL)
        assert ticks.count() == ticks.select("ts", "tick_id", "seq").distinct().count()
        a, b = ticks_to_bars(ticks), ticks_to_bars(ticks, unique=True)
        assert "SortAggregate" not in b._jdf.queryExecution().executedPlan().toString()
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    rows = [("A", "2024-03-10 00:00:00", 2**62, 0, 1.0), ("A", "2024-03-10 00:00:00", -(2**62), 3, 2.0),
            ("A", "2024-03-10 23:59:59.999999", -5, 59_999_999, 3.0), ("A", "2024-03-10 23:59:59.999999", -5, 2, 4.0),
            ("B", "1960-01-01 12:00:00", 1, None, 5.0), ("B", "1960-01-01 11:59:59.999999", 2, None, 6.0)]
    ticks = spark.createDataFrame(rows, "symbol string, ts string, tick_id long, seq long, price double").selectExpr(
        "symbol", "timestamp(ts) AS ts", "tick_id", "seq", "price", "1D AS qty")
    got = {r.symbol: (r.open, r.close) for r in ticks_to_bars(ticks, unique=True).collect()}
    assert got == {"A": (2.0, 3.0), "B": (6.0, 5.0)}
