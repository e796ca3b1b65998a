"""Hilbert-curve ordering: rows sorted along the curve over quantised metadata, cut into shards.

Dimensions (source, language, length of the text, words per character) are quantised to
``BITS`` bits each; near points on the curve are near in every dimension, so a shard covers a
small range of each and a filter on any of them skips most shards (``ranges``).

Law ``rows``: shard sizes differ by at most one row. The global position of a row comes from a
range partitioning by curve index and the counts of the partitions: no global window, and a
curve cell that holds a third of all rows is split by the tie-breaking columns. Only metadata
is sorted, never texts.

Null or empty texts have length 0, null sources and languages are a value of their own,
repeated rows each get a place, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import id_text
from tidemark.session import cut_lineage

BITS = 8
DIMS = 4


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distance along the Hilbert curve of integer points (n x d), after Skilling, "Programming
    the Hilbert curve" (2004), for all points at once."""
    x = points.T.astype(np.int64).copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess work of the inverse transform
        low = q - 1
        for i in range(d):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    index = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def dimensions(text: Column, source: Column, lang: Column) -> list[Column]:
    """DIMS quantised metadata values in 0 .. 2**BITS - 1."""
    top = (1 << BITS) - 1
    size = F.length(text)

    def spread(c):  # names have no order worth keeping; equal names share a value
        return F.pmod(F.xxhash64(F.coalesce(c.cast("string"), F.lit("\0"))), F.lit(1 << BITS)).cast("int")

    log = F.least(F.floor(F.log2(size + 1.0) * 10), F.lit(top)).cast("int")
    wide = F.octet_length(text) - size  # bytes beyond one per character: the script
    ratio = F.floor(F.when(size > 0, wide / size).otherwise(0.0) * 85)
    return [spread(source), spread(lang), log, F.least(ratio, F.lit(top)).cast("int")]


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        dims = [f"d{i}" for i in range(DIMS)]
        yield pdf.assign(curve=hilbert_index(pdf[dims].to_numpy()))


def order_and_cut(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, d0 .. d3, curve, shard and slot (gapless from 0 in each shard)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    dims = dimensions(text, F.col("source"), F.col("lang"))
    meta = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), *[d.alias(f"d{i}") for i, d in enumerate(dims)])
    schema = "doc_id string, size long, text_crc32 long, " + ", ".join(f"d{i} int" for i in range(DIMS)) + ", curve long"
    keys = ["curve", "text_crc32", "size", "doc_id"]
    placed = (meta.withColumn("doc_id", id_text("doc_id")).mapInPandas(_index, schema)
              .withColumn("doc_id", F.col("doc_id").cast("long"))
              .repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("at", F.monotonically_increasing_id()))
    placed = cut_lineage(placed)  # bounds of a range partitioning are sampled: places must not be drawn twice
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in counts)  # one number per partition reaches the driver
    if not total:
        return placed.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).drop("at")
    first, offset = 0, []
    for p, n in counts:
        offset += [F.lit(p).cast("long"), F.lit(first).cast("long")]
        first += n
    rank = F.element_at(F.create_map(*offset), part) + row
    scaled = rank * shards
    shard = ((scaled - F.pmod(scaled, F.lit(total))) / total).cast("long")  # an exact quotient
    start = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return (placed.withColumn("rank", rank).withColumn("shard", shard)
            .withColumn("slot", F.col("rank") - start).withColumn("shard", F.col("shard").cast("int"))
            .drop("at", "rank"))


def ranges(placed: DataFrame) -> DataFrame:
    """The least and greatest value of each dimension per shard: what a reader prunes by."""
    return placed.groupBy("shard").agg(
        F.count("*").alias("n_rows"), *[f(f"d{i}").alias(f"{n}_d{i}") for i in range(DIMS) for n, f in (("min", F.min), ("max", F.max))])


def shard_table(docs: DataFrame) -> DataFrame:
    """The sharding of documents, with the law it keeps."""
    return order_and_cut(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")
