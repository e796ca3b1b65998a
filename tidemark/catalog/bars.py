"""Bars and indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import oracle_sql as O
from tidemark.catalog import register
from tidemark.functions.presentation import rounded
from tidemark.operators.indicators import INDICATOR_COLUMNS, add_indicators
from tidemark.schemas import BAR_COLUMNS
from tidemark.sources.bars import bars_from, load_bars, period_filter
from tidemark.sources.snapshots import shared_path


BAR_DOUBLES = ["open", "high", "low", "close"]
BAR_OTHER = ["symbol", "date", "volume"]


def _bars_sql(source: str, where: str = "") -> str:
    return O.round_all(f"SELECT * FROM ({O.bars(source)}) b {where}", BAR_DOUBLES, BAR_OTHER)


# ---------------------------------------------------------------- S1-S3 bars
@register("ticks_to_bars_orders", _bars_sql("orders"))
def q_bars_orders(spark, sf):
    return rounded(bars_from(spark, sf, "orders"))


@register("ticks_to_bars_brands", _bars_sql("brands"))
def q_bars_brands(spark, sf):
    return rounded(bars_from(spark, sf, "brands"))


@register("load_bars_symbols",
          _bars_sql("orders", "WHERE symbol IN ('1-URGENT', '5-LOW')"))
def q_load_bars(spark, sf):
    return rounded(load_bars(spark, bars_from(spark, sf, "orders"), ["1-URGENT", "5-LOW"]))


def _load_stored(spark, sf, fmt):
    """Bars written as files of a format, then read back for three brands."""
    path = shared_path(spark, f"bars-{fmt}")
    bars_from(spark, sf, "brands").write.format(fmt).option("header", "true").save(path)
    return rounded(load_bars(spark, path, ["Brand#11", "Brand#23", "Brand#55"], fmt))


_STORED_SQL = _bars_sql("brands", "WHERE symbol IN ('Brand#11', 'Brand#23', 'Brand#55')")


@register("load_bars_parquet", _STORED_SQL)
def q_load_bars_parquet(spark, sf):
    return _load_stored(spark, sf, "parquet")


@register("load_bars_json", _STORED_SQL)
def q_load_bars_json(spark, sf):
    return _load_stored(spark, sf, "json")


@register("load_bars_csv", _STORED_SQL)
def q_load_bars_csv(spark, sf):
    return _load_stored(spark, sf, "csv")


@register("period_filter_60d", _bars_sql("orders").replace(
    "FROM (SELECT * FROM", "FROM (SELECT * EXCLUDE (_rn, _cnt) FROM (SELECT *, "
    "row_number() OVER (PARTITION BY symbol ORDER BY date) AS _rn, "
    "count(*) OVER (PARTITION BY symbol) AS _cnt FROM", 1).replace(
    ") b ", ") b) x WHERE _rn > _cnt - 60 ", 1))
def q_period_60d(spark, sf):
    return rounded(period_filter(bars_from(spark, sf, "orders"), "60d"))


@register("period_filter_6mo", _bars_sql("orders").replace(
    "FROM (SELECT * FROM", "FROM (SELECT * EXCLUDE (_asof) FROM (SELECT *, "
    "max(date) OVER (PARTITION BY symbol) AS _asof FROM", 1).replace(
    ") b ", ") b) x WHERE date > _asof - INTERVAL 6 MONTH ", 1))
def q_period_6mo(spark, sf):
    return rounded(period_filter(bars_from(spark, sf, "orders"), "6mo"))


@register("period_filter_ytd", _bars_sql("orders").replace(
    "FROM (SELECT * FROM", "FROM (SELECT * EXCLUDE (_asof) FROM (SELECT *, "
    "max(date) OVER (PARTITION BY symbol) AS _asof FROM", 1).replace(
    ") b ", ") b) x WHERE date >= date_trunc('year', _asof) ", 1))
def q_period_ytd(spark, sf):
    return rounded(period_filter(bars_from(spark, sf, "orders"), "ytd"))


# ---------------------------------------------------------------- W8 indicators
IND_DOUBLES = BAR_DOUBLES + INDICATOR_COLUMNS
_IND_SQL = O.round_all(O.indicators(f"({O.bars('orders')})"), IND_DOUBLES, BAR_OTHER)


def indicators_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: daily bars from ``orders`` → indicator columns for every symbol."""
    return rounded(add_indicators(bars_from(spark, sf, "orders")))


register("indicators_daily", _IND_SQL)(indicators_daily)


@register("indicators_blocked", _IND_SQL)
def q_indicators_blocked(spark, sf):
    # skew-safe blocked plan, small blocks so every symbol spans many chunks
    return rounded(add_indicators(bars_from(spark, sf, "orders"), block_rows=64, block_days=90))


@register("indicators_brands",
          O.round_all(O.indicators(f"({O.bars('brands')})"), IND_DOUBLES, BAR_OTHER))
def q_indicators_brands(spark, sf):
    return rounded(add_indicators(bars_from(spark, sf, "brands")))
