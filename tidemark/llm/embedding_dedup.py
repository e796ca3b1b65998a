"""Embedding near-duplicates: subspace pigeonhole join.

Unit vectors with cosine c are at squared distance 2 (1 - c). After a fixed random rotation the
dimensions are cut into ``SUBSPACES`` blocks; the squared distance is the sum over blocks, so
two vectors within it are, in at least one block, within the share proportional to the block's
dimensions. Each block is range-joined on its own coordinates; the union of the blocks' pairs,
well under a tenth of all pairs, is verified exactly on the original vectors.

Equal vectors of one label are one class with a multiplicity. The classes of a label are dealt into
stripes of about ``TILE`` classes and every pair of stripes is a group of its own, so no group exceeds
2 TILE rows, whatever a label holds, and each vector is sent once per stripe (once, where a label
fits a tile). A grid over a block's coordinates was measured and dropped: the radius (0.13) is as wide
as the spread of a coordinate (0.125 in 64 dimensions), so cells of two coordinates held ten times
the pairs of plain tiles, and finer ones reach almost every cell. Inside a tile the block distances come
from low-dimensional matrix products, ``SLICE`` rows at a time, and candidates are verified in bounded batches.

Groups return link counts per class and a spanning forest of the linked classes, never the pairs.

Null labels; vectors that are null, empty, zero or hold null or non-finite components: no
links, kept with their own id. Vectors of different lengths are not compared. Repeated rows
link with each other; rows with a null vec_id link with nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components, least_labels
from tidemark.llm.rows import give_back, id_text, ids_of
from tidemark.session import cut_lineage

COSINE = 0.93
SUBSPACES = 8
TILE = 2048
SLICE = 256
PAIRS = 1 << 16  # candidates verified at once
SEED = 93


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def cuts(dim: int) -> np.ndarray:
    """Block borders: at most SUBSPACES blocks of nearly equal dimension."""
    return np.unique(np.linspace(0, dim, min(SUBSPACES, dim) + 1).round().astype(int))


def _budgets(dim: int, cosine: float) -> np.ndarray:
    """Squared radius of each block, with room for rounding."""
    return 2 * (1 - cosine) * np.diff(cuts(dim)) / dim + 1e-9


def _usable(v) -> bool:
    if v is None or not len(v):
        return False
    x = np.array([np.nan if y is None else y for y in v], float) if v.dtype == object else np.asarray(v, float)
    return bool(np.isfinite(x).all() and x.any())


def _marked(batches):
    """Rows with the packed unit vector and a digest of the raw one (null if not comparable)."""
    for pdf in batches:
        unit, mark, dims = [], [], []
        for v, label in zip(pdf["embedding"], pdf["label"]):
            if label is None or not _usable(v):
                unit.append(None), mark.append(None), dims.append(0)
                continue
            x = np.asarray(v, np.float64) + 0.0  # no negative zeros
            x = x / np.abs(x).max()
            x /= np.sqrt((x * x).sum())
            unit.append(x.astype("<f8").tobytes())
            mark.append(xxhash.xxh3_128(unit[-1]).digest())
            dims.append(len(x))
        yield pd.DataFrame({"vec_id": ids_of(pdf["vec_id"]), "label": ids_of(pdf["label"]), "dim": np.array(dims, np.int32), "mark": mark, "unit": unit})


def candidates(y: np.ndarray, z: np.ndarray, budget: np.ndarray) -> np.ndarray:
    """Which rows of y and z (rotated vectors) are within the budget of at least one block."""
    borders = cuts(y.shape[1])
    near = np.zeros((len(y), len(z)), bool)
    for lo, hi, most in zip(borders[:-1], borders[1:], budget):
        a, b = y[:, lo:hi], z[:, lo:hi]
        near |= (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T) <= most
    return near


def links_between(x: np.ndarray, y: np.ndarray, budget: np.ndarray, rows: np.ndarray, cols: np.ndarray, cosine: float):
    """Pairs (p, q) of rows and columns with p < q and the cosine, found through the blocks, in bounded batches."""
    for at in range(0, len(rows), SLICE):
        own = rows[at: at + SLICE]
        p, q = np.nonzero(candidates(y[own], y[cols], budget))
        p, q = own[p], cols[q]
        keep = p < q
        p, q = p[keep], q[keep]
        for k in range(0, len(p), PAIRS):
            u, v = p[k: k + PAIRS], q[k: k + PAIRS]
            ok = np.einsum("ij,ij->i", x[u], x[v]) >= cosine
            if ok.any():
                yield u[ok], v[ok]


def _linked(cosine: float):
    """One pair of stripes (or one stripe): link counts of its classes and a forest of its links."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, i, j = (int(pdf[c].iloc[0]) for c in ("dim", "ti", "tj"))
        pdf = pdf.sort_values("stripe", kind="stable")
        x = np.stack([np.frombuffer(u, "<f8") for u in pdf["unit"]])
        y, budget = x @ rotation(dim), _budgets(dim, cosine)
        ids, m, stripe = (pdf[c].to_numpy() for c in ("id", "m", "stripe"))
        every = np.arange(len(ids))
        rows, cols = (every, every) if i == j else (every[stripe == i], every[stripe == j])
        counts, label = np.zeros(len(ids), np.int64), every.copy()
        for u, v in links_between(x, y, budget, rows, cols, cosine):
            np.add.at(counts, u, m[v])
            np.add.at(counts, v, m[u])
            label = least_labels(u, v, label)
        has, moved = np.flatnonzero(counts), np.flatnonzero(label != every)
        give_back()
        return pd.concat([pd.DataFrame({"a": ids[has], "b": -1, "n": counts[has]}),
                          pd.DataFrame({"a": ids[label[moved]], "b": ids[moved], "n": 0})], ignore_index=True).astype(
            {"a": "int64", "b": "int64", "n": "int64"})
    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors(vec_id, embedding, label)."""
    rows = vectors.select(id_text("vec_id").alias("vec_id"), "embedding", id_text("label").alias("label"))
    marked = cut_lineage(rows.mapInPandas(_marked, "vec_id long, label long, dim int, mark binary, unit binary"))
    usable = marked.filter("mark is not null and vec_id is not null")
    classes = usable.groupBy("label", "mark").agg(F.min("vec_id").alias("id"), F.count("*").alias("m"))
    first = usable.dropDuplicates(["label", "mark"]).select("label", "mark", "dim", "unit")
    one = cut_lineage(classes.join(first, ["label", "mark"]))
    # ids may repeat between classes, so a class is numbered by its digest
    one = one.withColumn("key", F.xxhash64("label", "mark"))
    where = ["label", "dim"]
    size = one.groupBy(*where).agg(F.count("*").alias("size")).withColumn("stripes", F.ceil(F.col("size") / TILE).cast("int"))
    met = one.select(F.col("key").alias("id"), "label", "dim", "m", "unit").join(size.filter("size > 1").drop("size"), where)
    met = met.withColumn("stripe", F.pmod(F.xxhash64("id"), F.col("stripes")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)))
    met = met.withColumn("ti", F.least("stripe", "other").cast("int")).withColumn("tj", F.greatest("stripe", "other").cast("int"))
    found = met.groupBy(*where, "ti", "tj").applyInPandas(_linked(cosine), "a long, b long, n long")
    found = cut_lineage(found)
    links = found.filter("b != -1 or n = 0").select("a", "b")
    counts = found.filter("n > 0").groupBy("a").agg(F.sum("n").alias("n"))
    label = components(links, "a", "b")
    # the component's name is its smallest vec_id, not its smallest class number
    named = one.join(label, one["key"] == label["id"], "left").select(
        "label", "mark", "key", "m", one["id"], F.coalesce("component", "key").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("least"))
    named = named.join(least, "root").join(counts, F.col("key") == F.col("a"), "left").select(
        "label", "mark", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "least")
    out = marked.join(named, ["label", "mark"], "left")
    return out.select(
        "vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("least", "vec_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
