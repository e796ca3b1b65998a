"""Work on whole symbols as arrays: daily bars are dealt and sorted by symbol once, and what several window
plans would each shuffle, sort and frame anew is taken from the arrays of a symbol. A symbol's daily bars are
bounded by the calendar (see ``indicators``); a task holds a group of them at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = 1 << 17  # bars held at a time, about
COLUMNS = ("day", "close", "volume", "whole")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[dict[str, np.ndarray]]]]:
    """Whole symbols, about ``GROUP`` bars of them at a time, from rows sorted by symbol."""
    held, n = [], 0

    def cut(last: bool):
        table = pa.Table.from_batches(held).combine_chunks()
        symbols = table.column("symbol").to_numpy()
        starts = np.r_[0, np.flatnonzero(symbols[1:] != symbols[:-1]) + 1]
        ends = np.r_[starts[1:], len(symbols)]
        done = len(starts) if last else len(starts) - 1  # more rows of the last one may follow
        cols = {c: table.column(c).to_numpy() for c in COLUMNS}
        return ([symbols[a] for a in starts[:done]], [{c: v[a:b] for c, v in cols.items()} for a, b in zip(starts[:done], ends)],
                table.slice(starts[-1]).combine_chunks().to_batches())

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= GROUP:
            symbols, series, held = cut(False)
            n = sum(b.num_rows for b in held)
            if symbols:
                yield symbols, series
            else:
                n = 0  # one symbol so far: looked at again a group later
    if held:
        yield cut(True)[:2]


def map_symbols(bars: DataFrame, fn: Callable[[list, list[dict[str, np.ndarray]]], pa.RecordBatch], schema: str, parts: int = 0) -> DataFrame:
    """``fn(symbols, series)`` on groups of whole symbols: a series is a dict of arrays in date order, ``day`` (days since
    1970), ``close`` and ``volume``, where NaN is null, and ``whole``: the date and all other columns are there."""
    def run(batches):
        for symbols, series in _groups(batches):
            yield fn(symbols, series)

    def there(f):
        return F.col(f.name).isNotNull() & (~F.isnan(f.name) if f.dataType.typeName() in ("double", "float") else F.lit(True))

    whole = functools.reduce(lambda a, b: a & b, [there(f) for f in bars.schema if f.name not in ("symbol", "close", "volume")])
    rows = bars.select("symbol", F.unix_date("date").cast("double").alias("day"), F.col("close").cast("double").alias("close"),
                       F.col("volume").cast("double").alias("volume"), whole.alias("whole"))
    parts = max(parts, int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, "symbol").sortWithinPartitions("symbol", "day").mapInArrow(run, schema)
