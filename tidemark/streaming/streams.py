"""Structured Streaming jobs.

All streams are file-source streams with a checkpoint in the shared folder and
``trigger(availableNow=True)``: each scheduled run processes exactly the files
that arrived since the previous run and stops. Files may arrive in any order of
event time, so nothing is dropped by a watermark: ``run_fold`` merges a batch's
partial aggregates into those of earlier batches, however late they come (``run_merge``
does the same for aggregates that cannot be merged, from raw rows of the days a batch
touches), and ``run_dedup`` looks up the keys already kept on those days. What a batch
writes is keyed by its id or by whole days, so a replayed batch (after a failure
between write and checkpoint commit) rewrites the same output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import QUOTE
from tidemark.sources import commits
from tidemark.sources.tables import no_nan


def quote_stream(spark: SparkSession, src: str) -> DataFrame:
    """Quotes JSON files → ``(symbol, ts timestamp, price, volume, status)``."""
    s = spark.readStream.schema(QUOTE).json(src)
    return s.withColumn("price", no_nan("price")).withColumn("ts", F.try_to_timestamp("timestamp"))


def ingest_quotes_stream(spark: SparkSession, src: str, bronze: str, checkpoint: str):
    """Append newly arrived quote files to the bronze Parquet table."""
    q = (quote_stream(spark, src).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).option("path", bronze)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _tumbled(df: DataFrame, ts: str, key: str, value: str, minutes: int) -> DataFrame:
    bad = F.col(value).isNull()
    if "status" in df.columns:
        bad = bad | F.coalesce(F.col("status") == "error", F.lit(False))
    return df.groupBy(F.window(ts, f"{minutes} minutes").alias("w"), key).agg(
        F.count(F.lit(1)).alias("invocations"), F.count(F.when(bad, 1)).alias("errors"),
        F.count(value).alias("n_values"), F.sum(value).alias("sum_value")).select(
        F.col("w.start").alias("window_start"), F.col(key).alias(key), "invocations", "errors", "n_values", "sum_value")


def tumbling_metrics(df: DataFrame, ts: str = "ts", key: str = "symbol", value: str = "price",
                     minutes: int = 5) -> DataFrame:
    """Invocations, errors, average and total value per key per tumbling window.

    An invocation without a value (or with status ``error``) is an error."""
    return finished_tumbling(_tumbled(df, ts, key, value, minutes), key)


def daily_bars(df: DataFrame) -> DataFrame:
    """T3 aggregation: same definition as the batch bars, per ``day``."""
    order = F.struct("ts", "tick_id", "price")
    return df.where(F.col("price").isNotNull()).groupBy("symbol", "day").agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.sum("volume").cast("long").alias("volume"))


def _batch_sink(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def run_to_sink(stream_df: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                transform=None):
    """Run a stream to completion into per-batch folders via ``foreachBatch``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform is not None else batch
        _batch_sink(sink)(out, batch_id)
    q = (stream_df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _arrived(batch: DataFrame, batch_id: int, root: str) -> DataFrame:
    """Stores a batch's rows in bronze under their day; rows without a time go to ``rejected``."""
    spark = batch.sparkSession
    dated = batch.withColumn("day", F.to_date("ts"))
    dated.where(F.col("day").isNotNull()).write.mode("overwrite").partitionBy("day").parquet(f"{root}/bronze/batch={batch_id}")
    dated.where(F.col("day").isNull()).drop("day").write.mode("overwrite").parquet(f"{root}/rejected/batch={batch_id}")
    schema = dated.schema
    return spark.read.schema(schema).parquet(f"{root}/bronze/batch={batch_id}")


def run_merge(stream_df: DataFrame, root: str, checkpoint: str, aggregate):
    """Keep ``aggregate(rows)`` current under ``root/state``, however late rows come.

    ``aggregate`` maps rows to one row per key, each key inside one day of ``ts``, and returns a
    ``day`` column. A batch recomputes the days it touches from bronze (both tables are
    partitioned by day, so only those are read and replaced).
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        new = _arrived(batch, batch_id, root)
        days = new.select("day").distinct()
        if days.isEmpty():
            return
        bronze = batch.sparkSession.read.schema(new.schema).option("basePath", f"{root}/bronze").parquet(f"{root}/bronze")
        now = aggregate(bronze.join(days, "day", "left_semi"))
        (now.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(f"{root}/state"))
    return _run(stream_df, checkpoint, merge)


def tumbling_partials(df: DataFrame, ts: str = "ts", key: str = "symbol", value: str = "price", minutes: int = 5) -> DataFrame:
    """T2 as partial aggregates: one row per key and window, with the day the window starts on."""
    return _tumbled(df, ts, key, value, minutes).withColumn("day", F.to_date("window_start"))


def merge_tumbling(partials: DataFrame, key: str = "symbol") -> DataFrame:
    names = ("invocations", "errors", "n_values", "sum_value")
    return partials.groupBy("day", "window_start", key).agg(*[F.sum(c).alias(c) for c in names])


def finished_tumbling(merged: DataFrame, key: str = "symbol") -> DataFrame:
    return merged.select("window_start", key, "invocations", "errors", F.try_divide("sum_value", "n_values").alias("avg_value"), "sum_value")


def bar_partials(df: DataFrame) -> DataFrame:
    """T3 as partial aggregates: bars with the order of their first and last tick."""
    order = F.struct("ts", "tick_id", "price")
    return df.where(F.col("price").isNotNull()).groupBy("symbol", F.to_date("ts").alias("day")).agg(
        F.min(order).alias("first"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max(order).alias("last"), F.sum("volume").cast("long").alias("volume"))


def merge_bars(partials: DataFrame) -> DataFrame:
    return partials.groupBy("symbol", "day").agg(
        F.min("first").alias("first"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max("last").alias("last"), F.sum("volume").alias("volume"))


def finished_bars(merged: DataFrame) -> DataFrame:
    return merged.select("symbol", "day", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), "volume")


COMPACT_EVERY = 16  # batches whose partials are kept apart


def run_fold(stream_df: DataFrame, root: str, checkpoint: str, partial: Callable[[DataFrame], DataFrame],
             merge: Callable[[DataFrame], DataFrame], compact_every: int = COMPACT_EVERY):
    """Keep ``merge`` of all batches' ``partial(rows)`` current under ``root/state``, by day.

    ``partial`` maps rows with a time to one row per key and a ``day`` that the key decides (a window
    belongs to the day it starts on, also if it crosses midnight); ``merge`` maps rows of that form
    to one row per key again. Raw rows are never read twice: a batch writes its partials and merges those
    of the days it touches, at most ``compact_every`` + 1 rows per key. Every ``compact_every`` batches
    the partials are merged into a base and the old ones deleted, so what is stored follows the keys, not the rows.

    ``root/late`` counts the rows of each batch from before the last day that earlier batches have a
    key on, ``root/rejected`` holds those without a time.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.where(F.col("ts").isNull()).write.mode("overwrite").parquet(f"{root}/rejected/batch={batch_id}")
        dated = batch.where(F.col("ts").isNotNull())
        own = f"{root}/partials/batch={batch_id}"
        partial(dated).write.mode("overwrite").parquet(own)
        new = spark.read.parquet(own)
        days = new.select("day").distinct()
        before = _kept_partials(spark, root, batch_id)
        newest = before.agg(F.max("day")).first()[0] if before is not None else None
        late = dated.where(F.to_date("ts") < F.lit(newest)) if newest is not None else dated.limit(0)
        (late.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
         .write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}"))
        every = new if before is None else before.unionByName(new)
        (merge(every.join(days, "day", "left_semi")).repartition("day").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{root}/state"))
        if (batch_id + 1) % compact_every == 0:
            merge(every).write.mode("overwrite").parquet(f"{root}/base/upto={batch_id}")
            _forget(spark, root, batch_id)
    return _run(stream_df, checkpoint, step)


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete ``<prefix>=<n>`` folders of ``path``."""
    names = [name for name, _ in commits.names_in(spark, path) if name.startswith(f"{prefix}=")]
    return sorted(int(name.split("=")[1]) for name in names if commits.path_exists(spark, f"{path}/{name}/_SUCCESS"))


def _kept_partials(spark: SparkSession, root: str, batch_id: int) -> DataFrame | None:
    """The newest base below a batch and the partials of the batches between; None if there are none."""
    bases = [n for n in _numbered(spark, f"{root}/base", "upto") if n < batch_id]
    after = bases[-1] if bases else -1
    paths = [f"{root}/base/upto={after}"] if bases else []
    paths += [f"{root}/partials/batch={n}" for n in _numbered(spark, f"{root}/partials", "batch") if after < n < batch_id]
    return spark.read.parquet(*paths) if paths else None


def _forget(spark: SparkSession, root: str, batch_id: int) -> None:
    """Deletes what the base up to a batch replaces. The batch itself and the base before it stay, as a
    replay of the batch reads them."""
    for n in _numbered(spark, f"{root}/base", "upto")[:-2]:
        commits.delete(spark, f"{root}/base/upto={n}")
    bases = _numbered(spark, f"{root}/base", "upto")
    if len(bases) > 1:
        for n in _numbered(spark, f"{root}/partials", "batch"):
            if n <= bases[-2]:
                commits.delete(spark, f"{root}/partials/batch={n}")


def run_dedup(stream_df: DataFrame, root: str, checkpoint: str, keys=("symbol", "ts"), order=("price",)):
    """T5 (stream): under ``root/kept`` the first row per key (by ``order`` within its batch),
    whenever its replays come; keys kept by earlier batches are looked up on the batch's days."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = _arrived(batch, batch_id, root)
        if new.isEmpty():
            return
        kept = spark.createDataFrame([], new.schema)
        if batch_id > 0:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/kept")
            if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
                schema = T.StructType([*new.schema.fields, T.StructField("batch", T.IntegerType())])
                kept = (spark.read.schema(schema).option("basePath", f"{root}/kept").parquet(f"{root}/kept")
                        .where(F.col("batch") < batch_id).drop("batch"))
        seen = kept.join(new.select("day").distinct(), "day", "left_semi").select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        first = dedup_quotes(new, keys, list(order))
        (first.join(seen, same, "left_anti").write.mode("overwrite").partitionBy("day").parquet(f"{root}/kept/batch={batch_id}"))
    return _run(stream_df, checkpoint, merge)


def _run(stream_df: DataFrame, checkpoint: str, merge):
    q = (stream_df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(merge).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """Rows written by ``run_to_sink`` (without the bookkeeping columns)."""
    return spark.read.parquet(path).drop("batch_id", "batch")


def dedup_quotes(df: DataFrame, keys=("symbol", "ts"), order="tick_id") -> DataFrame:
    """T5 (batch): one row per key, the first by ``order``; one aggregate, combined map-side."""
    order = [order] if isinstance(order, str) else list(order)
    row = F.struct(*[F.col(c) for c in df.columns])
    first = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_r"))
    return first.select("_r.*")
