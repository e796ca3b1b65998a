"""Tables written into the cluster's shared folder, to be read more than once."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame

from tidemark.session import ensure_checkpoint_dir


def release_shuffles(spark) -> None:
    """Spark deletes the shuffle files of finished steps when the driver collects the handles to them; a
    driver with little to do would keep those of every step until the job ends."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """df written as Parquet under ``spark.checkpoint.dir`` and read back: like a checkpoint, it
    survives lost executors and ends the lineage, but columnar and compressed. ``instead_of``: a
    table of this kind that nothing reads any more; it is deleted once the new one is complete."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    release_shuffles(spark)
    for old in {os.path.dirname(f) for f in instead_of.inputFiles()} if instead_of is not None else ():
        assert os.path.basename(old).startswith("table-")
        gone = spark._jvm.org.apache.hadoop.fs.Path(old)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return out
