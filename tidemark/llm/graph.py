"""Connected components of an edge table, by alternating large-star and small-star
steps (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Both steps are joins and minima with map-side combining; no neighbourhood is ever
gathered into one row, so a hub with a third of all edges is only a skewed join key. A table of
at most ``LOCAL`` edges (16 bytes each) is settled in one task instead of many small shuffles; the
result is the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

LOCAL = 1 << 20


def _toward_minimum(arcs: DataFrame) -> DataFrame:
    """arcs (u, v): for each u the least of itself and its neighbours, beside each arc."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return arcs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_toward_minimum(both).filter("v > u and v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _toward_minimum(down)
    moved = near.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = near.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def least_labels(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels of 0..n-1 after each end of the edges (a, b) took the least its edges reach, until none
    changes; a label is itself such a number, and is followed to its own."""
    label = label.copy()
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, before[a], least)
        np.minimum.at(label, before[b], least)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            return label


def _settled(batches):
    """All edges in one task."""
    pairs = [np.stack([pdf["u"].to_numpy(np.int64), pdf["v"].to_numpy(np.int64)]) for pdf in batches]
    names, code = np.unique(np.concatenate([np.empty((2, 0), np.int64), *pairs], axis=1), return_inverse=True)
    label = least_labels(*code.reshape(2, -1), np.arange(len(names)))
    yield pd.DataFrame({"id": names, "component": names[label]})


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(id, component): the smallest id reachable from each id that has an edge.

    Self-loops and repeated edges are fine; an empty table gives an empty one.
    """
    at = cut_lineage(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u != v"))
    if at.count() <= LOCAL:
        return cut_lineage(at.coalesce(1).mapInPandas(_settled, "id long, component long"))
    at = cut_lineage(at.distinct())
    seen = _mark(at)
    while seen[0]:
        at = cut_lineage(_small_star(_large_star(at)))
        now = _mark(at)
        if now == seen:
            break
        seen = now
    roots = at.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return at.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
