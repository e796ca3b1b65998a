"""Bars: daily OHLCV per symbol (S1 load, S2 ticks→bars, S3 period filter)."""

from __future__ import annotations

import re
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import BAR_COLUMNS, BARS
from tidemark.sources.tables import TICK_SOURCES, UNIQUE_TICKS, no_nan


# Parts of the order key below: a day's microseconds * ids * line numbers stay below 10**38.
_IDS, _LINES = 1 << 64, 60_000_000


def order_key() -> Column:
    """(time of day, tick id, line) of a tick as one number that orders ticks of a day alike.

    A 38-digit decimal has a fixed width in aggregation buffers, so first and last prices
    become hash aggregates, where a struct as key forces a sort. Lines must lie in 0 .. 59,999,999.
    """
    at = F.col("ts").cast("timestamp")
    time = (F.unix_micros(at) - F.unix_micros(F.date_trunc("day", at))).cast("decimal(12,0)")
    ids = F.col("tick_id").cast("decimal(19,0)") + F.lit(Decimal(_IDS // 2))
    lines = F.coalesce(F.col("seq"), F.lit(0)).cast("decimal(8,0)")
    return ((time * F.lit(Decimal(_IDS)) + ids).cast("decimal(31,0)") * F.lit(Decimal(_LINES)) + lines).cast("decimal(38,0)")


def ticks_to_bars(ticks: DataFrame, order_cols: Iterable[str] = ("ts", "tick_id", "seq"),
                  bucket: Column | None = None, unique: bool = False) -> DataFrame:
    """Daily OHLCV per symbol from a tick table ``(symbol, ts, ..., price, qty)``.

    open/close are the price of the first/last tick by ``order_cols``, of ticks equal in all
    of them the least/greatest price. All aggregates are partial (map-side combine), so a hot
    symbol is reduced to one row per (symbol, day, map task) before the shuffle.

    ``unique`` says that (ts, tick_id, seq) identify a tick, as in a table with that key: then no
    prices have to be told apart, the order is a fixed-width number (``order_key``) and the plan is a
    hash aggregate. Otherwise the order is a struct that ends in the price, and Spark sorts.
    """
    fixed = unique and bucket is None and tuple(order_cols) == ("ts", "tick_id", "seq")
    order = order_key() if fixed else F.struct(*[F.col(c) for c in order_cols], F.col("price"))
    key = bucket if bucket is not None else F.to_date("ts")
    return (ticks.withColumn("price", no_nan("price")).where(F.col("price").isNotNull())
            .groupBy("symbol", key.alias("date"))
            .agg(F.min_by("price", order).alias("open"),
                 F.max("price").alias("high"),
                 F.min("price").alias("low"),
                 F.max_by("price", order).alias("close"),
                 F.sum("qty").cast("long").alias("volume")))


def bars_from(spark: SparkSession, sf_dir: str, source: str = "orders") -> DataFrame:
    """Daily bars built from one of the given tables (see ``TICK_SOURCES``)."""
    return ticks_to_bars(TICK_SOURCES[source](spark, sf_dir), unique=source in UNIQUE_TICKS)


def load_bars(spark: SparkSession, path_or_df, symbols: Iterable[str] | None = None,
              fmt: str = "parquet") -> DataFrame:
    """Read bar history (a DataFrame, or parquet/json/csv files of the declared schema) for a symbol list.

    The ``isin`` filter is applied before anything else so it reaches the scan as
    a pushed filter (or a partition filter when the data is partitioned by symbol).
    """
    if isinstance(path_or_df, DataFrame):
        df = path_or_df
    else:
        df = spark.read.schema(BARS).format(fmt).option("header", "true").load(path_or_df)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    prices = ("open", "high", "low", "close")
    return df.select(*[no_nan(c).alias(c) if c in prices else F.col(c) for c in BAR_COLUMNS])


_PERIOD = re.compile(r"^(\d+)(d|mo|y)$")


def period_filter(bars: DataFrame, period: str = "1y", as_of=None) -> DataFrame:
    """S3: keep the bars of a period per symbol.

    ``{n}d`` → the last n bars; ``{n}mo``/``{n}y`` → dates after ``as_of`` minus
    n months/years; ``ytd`` → dates from Jan 1 of ``as_of``'s year; ``max`` → all.
    ``as_of`` defaults to each symbol's latest bar (never the wall clock).
    The windows share ``partitionBy(symbol)`` with the indicator window, so the
    planner reuses one exchange.
    """
    if as_of is not None:
        bars = bars.where(F.col("date") <= F.to_date(F.lit(str(as_of))))
    if period == "max":
        return bars
    by_symbol = Window.partitionBy("symbol")
    asof = F.max("date").over(by_symbol) if as_of is None else F.to_date(F.lit(str(as_of)))
    if period == "ytd":
        return (bars.withColumn("_asof", asof)
                .where(F.col("date") >= F.trunc("_asof", "year")).drop("_asof"))
    m = _PERIOD.match(period)
    if not m:
        raise ValueError(f"unsupported period: {period}")
    n, unit = int(m.group(1)), m.group(2)
    if unit == "d":
        # last n rows per symbol: rank from the end via count - row_number
        w = by_symbol.orderBy("date")
        return (bars.withColumn("_rn", F.row_number().over(w))
                .withColumn("_cnt", F.count(F.lit(1)).over(by_symbol))
                .where(F.col("_rn") > F.col("_cnt") - n)
                .drop("_rn", "_cnt"))
    months = n if unit == "mo" else 12 * n
    return (bars.withColumn("_asof", asof)
            .where(F.col("date") > F.add_months("_asof", -months)).drop("_asof"))
