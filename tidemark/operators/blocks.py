"""Windows over long series in blocks: dense positions, and chunks with the neighbours they need.

A window partitioned by symbol puts a series into one task. Here a series is cut into chunks of
``block_rows`` consecutive rows, and every row is copied into each chunk whose frames reach it: the last
``before`` rows of a chunk into the next one, the first ``after`` rows into the one before. A window over
(symbol, chunk) then sees for the chunk's own rows exactly what a window over the symbol would, and
the work spreads over rows / block_rows tasks. The rows are read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def positioned(df: DataFrame, block_days: int = 256, order: str = "date") -> DataFrame:
    """Add ``_rn`` (1-based row position per symbol) and ``_n`` (rows of the symbol) without one
    task per symbol.

    Rows are numbered inside calendar blocks of ``block_days`` (bounded: at most one bar a day) and
    offset by the counts of earlier blocks: a table of rows / block size, made from the same numbered
    rows. These are checkpointed, so what is below is computed once.
    """
    block = F.floor(F.unix_date(F.col(order)) / F.lit(block_days))
    numbered = cut_lineage(df.withColumn("_blk", block).withColumn(
        "_lrn", F.row_number().over(Window.partitionBy("symbol", "_blk").orderBy(order))))
    counts = numbered.groupBy("symbol", "_blk").agg(F.count(F.lit(1)).alias("_m"))
    by_symbol = Window.partitionBy("symbol")
    earlier = by_symbol.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("symbol").alias("_symbol"), F.col("_blk").alias("_at"),
                            F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_off"), F.sum("_m").over(by_symbol).alias("_n"))
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_blk") == F.col("_at"))
    return numbered.join(offsets, same).select(*df.columns, (F.col("_off") + F.col("_lrn")).alias("_rn"), "_n")


def in_chunks(df: DataFrame, block_rows: int, before: int = 0, after: int = 0) -> DataFrame:
    """Positioned rows, each in every chunk (``_chunk``) that needs it; ``_own`` marks the chunk it lies in."""
    at = F.col("_rn") - 1
    first = F.greatest(F.floor((at - after) / block_rows), F.lit(0))
    return (df.withColumn("_chunk", F.explode(F.sequence(first, F.floor((at + before) / block_rows))))
            .withColumn("_own", F.col("_chunk") == F.floor(at / block_rows)))


def chunk_window() -> WindowSpec:
    return Window.partitionBy("symbol", "_chunk").orderBy("_rn")


def own_rows(df: DataFrame, *drop: str) -> DataFrame:
    return df.where("_own").drop("_own", "_chunk", *drop)

