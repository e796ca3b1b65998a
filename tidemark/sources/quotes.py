"""Quote records as JSON (one object per quote), partitioned by symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import QUOTE
from tidemark.sources.tables import no_nan


def quotes_from_ticks(ticks: DataFrame, status: str = "collected") -> DataFrame:
    """Quote records ``(symbol, timestamp ISO-8601 text, price, volume, status)``."""
    return ticks.select("symbol",
                        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                        F.col("price"), F.col("qty").cast("long").alias("volume"), F.lit(status).alias("status"))


def write_quotes_json(quotes: DataFrame, root: str) -> None:
    quotes.write.mode("append").partitionBy("symbol").json(root)


def read_quotes_json(spark: SparkSession, root: str) -> DataFrame:
    """Read with the declared schema (no inference) and parse the timestamp."""
    df = spark.read.schema(QUOTE).json(root)
    return df.withColumn("price", no_nan("price")).withColumn("ts", F.try_to_timestamp("timestamp"))
