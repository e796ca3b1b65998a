"""Readers for the given Parquet tables and their mapping onto ticks.

Every reader projects only the columns it needs so the Parquet scan prunes
columns (``ReadSchema``) and filters on ``symbol`` push down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def no_nan(c: Column | str) -> Column:
    """Every reader's rule for doubles: not-a-number is NULL."""
    return F.nanvl(F.col(c) if isinstance(c, str) else c, F.lit(None).cast("double"))


def _ticks(df: DataFrame, symbol, ts, tick_id, seq, price, qty) -> DataFrame:
    return df.select(symbol.cast("string").alias("symbol"), ts.alias("ts"),
                     tick_id.cast("long").alias("tick_id"), seq.cast("long").alias("seq"),
                     no_nan(price.cast("double")).alias("price"), no_nan(qty.cast("double")).alias("qty"))


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as trades: symbol = order priority, price = total price, one unit each."""
    o = read_table(spark, sf_dir, "orders")
    return _ticks(o, F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_orderkey"),
                  F.lit(0), F.col("o_totalprice"), F.lit(1.0))


def brand_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part as trades: symbol = brand, price = unit price, qty = quantity.

    ``part`` is a dimension that grows with the scale factor, so no broadcast is
    forced: the planner (and AQE at runtime) broadcasts it only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
    both sides on ``partkey`` otherwise.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return _ticks(j, F.col("p_brand"), F.col("l_shipdate"), F.col("l_orderkey"),
                  F.col("l_linenumber"),
                  F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
                  F.col("l_quantity"))


def supplier_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as trades of many instruments: symbol = supplier key."""
    li = read_table(spark, sf_dir, "lineitem")
    return _ticks(li, F.col("l_suppkey"), F.col("l_shipdate"), F.col("l_orderkey"),
                  F.col("l_linenumber"),
                  F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
                  F.col("l_quantity"))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as quotes: symbol = event type, price = value."""
    e = read_table(spark, sf_dir, "events")
    return _ticks(e, F.col("event_type"), F.col("ts"), F.col("event_id"), F.lit(0),
                  F.col("value"), F.lit(1.0))


TICK_SOURCES = {
    "orders": order_ticks,
    "brands": brand_ticks,
    "suppliers": supplier_ticks,
    "events": event_ticks,
}

# Sources whose (ts, tick_id, seq) is a key of the table; line items repeat order and line numbers.
UNIQUE_TICKS = {"orders", "events"}
