"""Declared schemas of the domain tables."""

from pyspark.sql import types as T

BAR_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume"]

BARS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

# Normalised trade/quote stream: one priced event per row.
TICKS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("tick_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty", T.DoubleType()),
])

QUOTE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("status", T.StringType()),
])

REQUEST = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("days_ahead", T.IntegerType()),
])
