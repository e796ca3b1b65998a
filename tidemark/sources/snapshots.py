"""Snapshots, model tables, status history and inventory.

A snapshot store is a folder of writes and a log of commits (see ``commits``). A write is
``data/write=<id>``, Parquet cut by ranges of the symbol, and ``manifest/write=<id>``, the rows of
each symbol in each file. Its commit, written last, names the stamp (``yyyyMMdd_HHmmss`` text), the
write and its files with bytes, rows and symbol range. Readers start from the log: a write that
failed half way is never seen, and writing a stamp again replaces it. Symbols are column
values, never folder names, so any text is a symbol.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage, ensure_checkpoint_dir
from tidemark.sources import commits
from tidemark.sources.commits import path_exists

STAMP_FMT = "yyyyMMdd_HHmmss"
# Fixed values of the reference's storage lifecycle rule (days → tier).
LIFECYCLE = [(365, "DEEP_ARCHIVE"), (90, "GLACIER"), (30, "STANDARD_IA"), (0, "STANDARD")]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tidemark/{name}-{uuid.uuid4().hex}"


def write_snapshot(df: DataFrame, root: str, snapshot_ts: str) -> int:
    """One immutable snapshot of every symbol in ``df``, stamped ``snapshot_ts``; returns its version.

    Rows are range-partitioned by symbol, so a file holds whole symbols of a narrow range. What
    the commit says of the files is read back from what was written (the symbol column alone).
    One row per file reaches the driver.
    """
    spark, root, write_id = df.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    data, manifest = f"{root}/data/write={write_id}", f"{root}/manifest/write={write_id}"
    df = df.withColumn("symbol", F.col("symbol").cast("string")).withColumn("snapshot_ts", F.lit(snapshot_ts))
    df.repartitionByRange("symbol").sortWithinPartitions("symbol").write.parquet(data)
    (spark.read.schema("symbol string").parquet(data)
     .groupBy("symbol", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))
     .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("snapshot_ts", F.lit(snapshot_ts)).write.parquet(manifest))
    files = (spark.read.schema(_MANIFEST).parquet(manifest).groupBy("file")
             .agg(F.max("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"),
                  F.min("symbol").alias("min_symbol"), F.max("symbol").alias("max_symbol")).orderBy("file").collect())
    return commits.append(spark, root, snapshot_ts, write_id, [r.asDict() for r in files])


_MANIFEST = "symbol string, file string, bytes long, n_rows long, snapshot_ts string"


def _read_files(spark: SparkSession, root: str, schema: T.StructType, files: list[str]) -> DataFrame:
    fields = [f for f in schema.fields if f.name != "snapshot_ts"]
    full = T.StructType([*fields, T.StructField("snapshot_ts", T.StringType())])
    if not files:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(*[f"{root}/data/{f}" for f in files])


def _named(files: DataFrame) -> list[str]:
    return [f"write={r['id']}/{r['file']}" for r in files.where("file is not null").select("id", "file").distinct().collect()]


def read_latest_snapshot(spark: SparkSession, root: str, schema: T.StructType,
                         requested: DataFrame | None = None, prune: bool = True) -> tuple[DataFrame, DataFrame]:
    """Newest snapshot per symbol, plus ``missing(symbol)``: requested symbols
    without any snapshot (J3, a left anti join).

    The newest stamp of each symbol comes from the manifests of the committed writes and is
    joined to the data. ``prune=True`` first restricts the scan to the files that hold a symbol's newest
    rows: one name per such file reaches the driver, as in any file listing.
    """
    root = root.rstrip("/")
    log = commits.live(spark, root).select("snapshot_ts", "id", "file").distinct()
    writes = sorted({r["id"] for r in log.select("id").distinct().collect()})
    manifest = spark.createDataFrame([], _MANIFEST)
    if writes:
        manifest = spark.read.schema(_MANIFEST).parquet(*[f"{root}/manifest/write={w}" for w in writes])
    newest = manifest.groupBy("symbol").agg(F.max("snapshot_ts").alias("snapshot_ts"))
    missing = spark.createDataFrame([], "symbol string")
    if requested is not None:
        wanted = requested.select("symbol").distinct()
        missing = wanted.join(newest, "symbol", "left_anti")
        newest = newest.join(wanted, "symbol", "left_semi")
    if prune:
        newest = cut_lineage(newest)
        files = manifest.join(newest, ["symbol", "snapshot_ts"], "left_semi").select("snapshot_ts", "file").distinct()
        log = log.join(files, ["snapshot_ts", "file"], "left_semi")
    return _read_files(spark, root, schema, _named(log)).join(newest, ["symbol", "snapshot_ts"]), missing


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType, snapshot_ts: str, symbols: list[str]) -> DataFrame:
    """The rows of a few symbols in one snapshot, from those files alone whose symbol range holds one of them."""
    root = root.rstrip("/")
    files = commits.live(spark, root).where(F.col("snapshot_ts") == snapshot_ts)
    wanted = spark.createDataFrame([(s,) for s in set(symbols)], "symbol string")
    files = files.join(wanted, (F.col("symbol") >= F.col("min_symbol")) & (F.col("symbol") <= F.col("max_symbol")), "left_semi")
    return _read_files(spark, root, schema, _named(files)).where(F.col("symbol").isin(list(symbols)))


def snapshot_log(spark: SparkSession, root: str) -> DataFrame:
    """(snapshot_ts, version, files, bytes, n_rows, min_symbol, max_symbol) per live snapshot, from the log alone."""
    return commits.live(spark, root.rstrip("/")).groupBy("snapshot_ts", "version").agg(
        F.count("file").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.min("min_symbol").alias("min_symbol"), F.max("max_symbol").alias("max_symbol"))


def remove_uncommitted(spark: SparkSession, root: str, older_than_ms: int) -> list[str]:
    """Deletes writes that no live commit names (failed or replaced ones) and that were last touched
    before ``older_than_ms``, so that writes under way stay. Returns their ids."""
    root = root.rstrip("/")
    kept = {r["id"] for r in commits.live(spark, root).select("id").distinct().collect()}
    gone = set()
    for part in ("data", "manifest"):
        for name, at in commits.names_in(spark, f"{root}/{part}"):
            if name.startswith("write=") and name[6:] not in kept and at < older_than_ms:
                commits.delete(spark, f"{root}/{part}/{name}")
                gone.add(name[6:])
    return sorted(gone)


def write_models(models: DataFrame, root: str) -> None:
    """Append model rows, partitioned by model type."""
    models.write.mode("append").partitionBy("model_type").parquet(root)


def load_latest_model(models: DataFrame) -> DataFrame:
    """Newest row per (model_type, symbol) by ``created_at``, of equally new ones the one that
    is last as JSON text; NULL metrics → {}."""
    row = F.struct(*[c for c in models.columns if c not in ("model_type", "symbol")])
    latest = models.groupBy("model_type", "symbol").agg(F.max_by(row, F.struct("created_at", F.to_json(row))).alias("_m"))
    out = latest.select("model_type", "symbol", "_m.*")
    if "metrics" in out.columns:
        out = out.withColumn("metrics", F.coalesce("metrics", F.create_map().cast("map<string,double>")))
    return out


def write_status_history(status: DataFrame, root: str) -> None:
    """Append timestamped status records as JSON."""
    status.write.mode("append").json(root)


def write_alerts(alerts: DataFrame, root: str) -> None:
    """Append alerts as JSON records; a message of several lines is one record."""
    alerts.write.mode("append").json(root)


_FILES = "path string, length long, modificationTime timestamp"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length, modificationTime)`` of the Parquet files under ``path``, none if it is
    absent. The ``binaryFile`` source with only its metadata columns selected never reads
    contents, and its listing is distributed."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], _FILES)
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime"))


def _summed(files: DataFrame, *by) -> DataFrame:
    return files.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                                  F.max("modificationTime").alias("latest_modified")).withColumn(
        "size_kb", F.round(F.col("bytes") / 1024, 2))


def file_inventory(spark: SparkSession, path: str, name: str) -> DataFrame:
    """File count, total bytes (and KB, F8) and newest modification time of the Parquet files
    under ``path``; an absent path has no files."""
    return _summed(list_files(spark, path)).select(
        F.lit(name).alias("resource"), "files", "bytes", "size_kb", "latest_modified")


def table_inventory(spark: SparkSession, root: str) -> DataFrame:
    """A7 of every ``<name>.parquet`` table under ``root``, from one listing."""
    name = F.regexp_extract("path", r"/([^/]+)\.parquet(/|$)", 1)
    return _summed(list_files(spark, root), name.alias("resource")).select(
        "resource", "files", "bytes", "size_kb", "latest_modified")


def lifecycle_tiers(log: DataFrame, as_of) -> DataFrame:
    """Snapshots, files, bytes and rows per storage tier by the snapshot's age on ``as_of``, from ``snapshot_log``."""
    day = F.to_date(F.to_timestamp("snapshot_ts", STAMP_FMT))
    return log.groupBy(lifecycle_tier(F.datediff(F.lit(str(as_of)).cast("date"), day)).alias("tier")).agg(
        F.count(F.lit(1)).alias("snapshots"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"))


def lifecycle_tier(age_days) -> F.Column:
    """Storage tier by age in days."""
    expr = None
    for days, tier in LIFECYCLE:
        cond = age_days >= days
        expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
    return expr
