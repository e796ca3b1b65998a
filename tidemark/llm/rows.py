"""Row identifiers on their way into Python and back, and memory on its way back to the system.

A nullable long reaches pandas as float64, which cannot hold integers above 2**53, as soon as one
row of a batch is null. So identifiers travel as text and come back as nullable integers.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def id_text(column: str | Column) -> Column:
    """An integer column as decimal text (null stays null), to be read by ``ids_of``."""
    return (F.col(column) if isinstance(column, str) else column).cast("long").cast("string")


def id_of(text) -> int | None:
    return int(text) if isinstance(text, str) else None


def ids_of(texts: Iterable) -> pd.arrays.IntegerArray:
    """Decimal texts as a nullable 64-bit integer array, exact for all longs."""
    return pd.array([id_of(x) for x in texts], "Int64")


def small_batches(spark: SparkSession) -> None:
    """From now on rows reach Python in batches of 4 MB, unless the session names a size of its own.

    A batch is held whole several times: as vectors and as a message outside the JVM's heap, and as a
    message and as objects in the worker. Spark's limits (10,000 rows, 64 MB) make that some hundred
    MB a task where rows are texts."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)


def give_back() -> None:
    """Returns what this worker has freed to the system: workers are reused, and an executor's
    memory is what all its workers ever held at once."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: nothing to do
        pass
