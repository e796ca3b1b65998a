import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, bars_df, series
from tidemark.operators.indicators import INDICATOR_COLUMNS, add_indicators
from tidemark.sources.bars import bars_from, period_filter


def by_date(df):
    return [r.asDict() for r in df.orderBy("symbol", "date").collect()]


def test_f1_three_bars_all_null(spark):
    b = bars_df(spark, [("2024-01-01", 100.0, 105.0, 99.0, 104.0, 1000),
                        ("2024-01-02", 101.0, 106.0, 100.0, 105.0, 1100),
                        ("2024-01-03", 102.0, 107.0, 101.0, 106.0, 1200)])
    rows = by_date(add_indicators(b))
    assert set(INDICATOR_COLUMNS) <= set(rows[0])
    assert all(r[c] is None for r in rows for c in INDICATOR_COLUMNS)


def test_f2_twenty_bar_ramp(spark):
    rows = by_date(add_indicators(series(spark, [100.0 + i for i in range(20)])))
    assert [r["MA_5"] is None for r in rows].index(False) == 4
    assert rows[4]["MA_5"] == pytest.approx(102.0)
    assert rows[-1]["MA_5"] == pytest.approx(117.0)
    assert rows[-1]["MA_20"] == pytest.approx(109.5) and rows[-1]["BB_Middle"] == pytest.approx(109.5)
    assert all(r["MA_50"] is None for r in rows)
    assert rows[-1]["Volume_MA"] == pytest.approx(1000.0)
    assert [r["RSI"] is None for r in rows].index(False) == 13
    assert rows[13]["RSI"] == pytest.approx(100.0)
    assert rows[-1]["BB_Upper"] == pytest.approx(109.5 + 2 * math.sqrt(35))
    assert rows[-1]["BB_Lower"] == pytest.approx(109.5 - 2 * math.sqrt(35))


def test_flat_and_falling_series(spark):
    flat = by_date(add_indicators(series(spark, [50.0] * 25)))
    assert all(r["RSI"] is None for r in flat)
    assert flat[-1]["BB_Upper"] == pytest.approx(50.0) and flat[-1]["BB_Lower"] == pytest.approx(50.0)
    down = by_date(add_indicators(series(spark, [100.0 - i for i in range(20)], "DOWN")))
    assert down[-1]["RSI"] == pytest.approx(0.0)


def test_null_close_in_middle(spark):
    closes = [100.0 + i for i in range(30)]
    closes[10] = None
    rows = by_date(add_indicators(series(spark, closes)))
    # every 5-row frame touching row 10 is NULL
    assert all(rows[i]["MA_5"] is None for i in range(10, 15))
    assert rows[15]["MA_5"] == pytest.approx(sum(closes[11:16]) / 5)
    # the NULL close counts as zero change for RSI, so RSI continues
    assert rows[20]["RSI"] is not None


def test_blocked_plan_equals_plain(spark):
    b = bars_from(spark, SF_MID, "orders")
    plain = add_indicators(b)
    for block_rows, block_days in ((64, 30), (49, 7), (500, 256)):
        blocked = add_indicators(b, block_rows=block_rows, block_days=block_days)
        assert plain.exceptAll(blocked).count() == 0
        assert blocked.exceptAll(plain).count() == 0


def test_properties(spark):
    ind = add_indicators(bars_from(spark, SF_MID, "brands"))
    bad = ind.where((F.col("RSI") < 0) | (F.col("RSI") > 100)
                    | (F.col("BB_Lower") > F.col("BB_Middle")) | (F.col("BB_Middle") > F.col("BB_Upper")))
    assert bad.count() == 0
    warm = ind.groupBy("symbol").agg(F.sum(F.col("MA_20").isNull().cast("int")).alias("nulls"),
                                     F.count(F.lit(1)).alias("n"))
    assert all(r.nulls == min(19, r.n) for r in warm.collect())


def test_period_filter(spark):
    b = series(spark, [100.0 + i for i in range(400)])
    assert period_filter(b, "5d").count() == 5
    assert period_filter(b, "max").count() == 400
    last = b.agg(F.max("date")).first()[0]
    one_y = period_filter(b, "1y")
    assert one_y.agg(F.min("date")).first()[0] > last.replace(year=last.year - 1)
    with pytest.raises(ValueError):
        period_filter(b, "3w")
