"""Commit records of a snapshot store: small JSON files, one per version, written last and read first.

A record is complete or absent: it is written under another name and renamed to
``_log/<version>.json``, which fails where that version exists, so of two writers one takes the next
version. It has one line per data file of the commit (name, bytes, rows, least and greatest
symbol), or a single line without a file. Only Hadoop file-system calls and Spark readers are used, so a
store may live wherever Spark can write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD = ("version long, snapshot_ts string, id string, file string, bytes long, n_rows long, "
          "min_symbol string, max_symbol string")
FIELDS = [f.split()[0] for f in RECORD.split(", ")]


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = _path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def names_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of the entries of a folder; none if it is absent."""
    if not path_exists(spark, path):
        return []
    p = _path(spark, path)
    return [(x.getPath().getName(), x.getModificationTime())
            for x in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    p = _path(spark, path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name[:-5]) for name, _ in names_in(spark, f"{root}/_log") if name.endswith(".json") and name[:-5].isdigit())


def append(spark: SparkSession, root: str, snapshot_ts: str, write_id: str, files: Iterable[dict]) -> int:
    """Commits a write under the next free version, which it returns."""
    lines = [{"snapshot_ts": snapshot_ts, "id": write_id, **f} for f in files] or [{"snapshot_ts": snapshot_ts, "id": write_id}]
    conf = spark._jsc.hadoopConfiguration()
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = _path(spark, f"{root}/_log/.draft-{uuid.uuid4().hex}")
    context = hadoop.FileContext.getFileContext(draft.getFileSystem(conf).getUri(), conf)
    keep = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    keep[0] = hadoop.Options.Rename.NONE
    version = max(_versions(spark, root), default=-1) + 1
    while True:
        out = draft.getFileSystem(conf).create(draft, True)
        out.write(bytearray("".join(json.dumps({"version": version, **x}) + "\n" for x in lines).encode()))
        out.close()
        try:
            context.rename(draft, _path(spark, f"{root}/_log/{version:020d}.json"), keep)
            return version
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            version += 1  # another writer was first


def live(spark: SparkSession, root: str) -> DataFrame:
    """The records of each stamp's last commit: writing a stamp again replaces it."""
    if not _versions(spark, root):
        return spark.createDataFrame([], RECORD)
    last = F.max("version").over(Window.partitionBy("snapshot_ts"))
    return (spark.read.schema(RECORD).json(f"{root}/_log/*.json").withColumn("_last", last)
            .where("version = _last").select(*FIELDS))
