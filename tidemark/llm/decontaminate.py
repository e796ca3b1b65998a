"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Distinct benchmark items are dealt by hash into blocks of about ``BLOCK`` items; the tables of
one block (shingle hashes, fingerprints, block keys) are broadcast, so their size does not grow
with the benchmark, and documents are scanned once per block without any shuffle of texts. The
weights of the shingles that several items have (16 bytes each) are sent once, for all blocks.

A window as long as an item can only reach the similarity ``threshold`` (at most 1 shingle in
1/threshold differs) if it shares a shingle with the item. Every shared shingle at word p that
stands at word o of the item gives the window [p - o, p - o + length); all such windows, over
the whole text, are fingerprinted and compared with their own item, so that what is found does
not depend on the other items of a block. A 64-bit SimHash over weighted shingles is cut into eight
blocks; two fingerprints within ``RADIUS`` agree in one block up to RADIUS // 8 bits
(pigeonhole), so looking up each block of a window among the item blocks and their neighbours
up to that distance finds every item within the radius. Candidates are verified by weighted
Jaccard similarity of the shingle multisets.

Weights: log(1 + items / items with the shingle) over all distinct items with words, whatever
their blocks; shingles that no item has weigh like those of one item. Items and texts without words match nothing; null ids are
carried; repeated item rows are one item, equal texts under other ids are reported each, and
so are repeated documents.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import id_text, ids_of, small_batches
from tidemark.llm.words import SHINGLE, window_hashes, words_of

THRESHOLD = 0.75
RADIUS = 20
BLOCKS = 8
BLOCK = 4096
MATCHES = "doc_id long, item_id long, start_word long, n_words long, hamming int, similarity double"
_BITS = np.arange(64, dtype=np.uint64)
_POP = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def simhash(hashes: np.ndarray, weights: np.ndarray) -> int:
    bits = ((hashes[:, None] >> _BITS) & np.uint64(1)).astype(np.float64) * 2 - 1
    return int(((weights @ bits) > 0).astype(np.uint64) @ (np.uint64(1) << _BITS))


def hamming(a: np.ndarray, b: int) -> np.ndarray:
    x = a ^ np.uint64(b)
    return sum(_POP[(x >> np.uint64(s) & np.uint64(0xFFFF)).astype(np.int64)].astype(int) for s in (0, 16, 32, 48))


class Weights:
    """Weights of all shingles in a benchmark of ``total`` items, from those that several items have."""

    def __init__(self, total: int, hashes: np.ndarray, counts: np.ndarray):
        by = np.argsort(hashes)
        self.hashes = hashes[by]
        self.values = np.log(1 + total / counts[by])
        self.unit = float(np.log(1 + total))

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Weights:
        h, n = np.unique(np.concatenate([np.empty(0, np.uint64), *map(np.unique, sets)]), return_counts=True)
        return cls(len(sets), h[n > 1], n[n > 1])

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), self.unit)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.values[at], self.unit)


class Items:
    """The lookup tables of one block of benchmark items; weights: of the whole benchmark, or those
    of the block alone."""

    def __init__(self, rows: list[tuple[int | None, str | None]], weights: Weights | None = None):
        words = [(i, words_of(t)) for i, t in rows]
        words = [(i, w) for i, w in words if w]
        self.ids = [i for i, _ in words]
        self.lengths = np.array([len(w) for _, w in words], np.int64)
        self.hashes = [window_hashes(w, SHINGLE) for _, w in words]
        self.weights = weights or Weights.of(self.hashes)
        self.prints = np.array([simhash(h, self.weights(h)) for h in self.hashes], np.uint64)
        self.counts = [self.counted(h) for h in self.hashes]
        # places of each shingle, by shingle length (short items are one shorter shingle)
        self.places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({min(SHINGLE, int(n)) for n in self.lengths}):
            own = [k for k, n in enumerate(self.lengths) if min(SHINGLE, n) == size]
            h = np.concatenate([self.hashes[k] for k in own])
            at = np.concatenate([np.arange(len(self.hashes[k])) for k in own])
            item = np.repeat(own, [len(self.hashes[k]) for k in own])
            by = np.argsort(h, kind="stable")
            self.places[size] = h[by], at[by], item[by]
        width = 64 // BLOCKS
        near = [sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in itertools.combinations(range(width), r)]
        self.index: dict[tuple[int, int], list[int]] = {}
        for k, p in enumerate(self.prints.tolist()):
            for b in range(BLOCKS):
                part = p >> (b * width) & ((1 << width) - 1)
                for flip in near:
                    self.index.setdefault((b, part ^ flip), []).append(k)

    def counted(self, hashes: np.ndarray) -> dict[int, int]:
        return dict(zip(*(x.tolist() for x in np.unique(hashes, return_counts=True))))

    def within(self, fingerprint: int) -> list[int]:
        """Items whose fingerprint is within RADIUS, by the block index."""
        width = 64 // BLOCKS
        found = {k for b in range(BLOCKS) for k in self.index.get((b, fingerprint >> (b * width) & ((1 << width) - 1)), ())}
        found = np.array(sorted(found), np.int64)
        return found[hamming(self.prints[found], fingerprint) <= RADIUS].tolist() if len(found) else []

    def similarity(self, k: int, hashes: np.ndarray) -> float:
        own, other = self.counts[k], self.counted(hashes)
        both = least = 0.0
        every = np.array(sorted(own.keys() | other.keys()), np.uint64)
        for x, w in zip(every.tolist(), self.weights(every).tolist()):
            a, b = own.get(x, 0), other.get(x, 0)
            least += w * min(a, b)
            both += w * max(a, b)
        return least / both

    def search(self, text: str | None, threshold: float) -> dict[int, tuple]:
        """item number -> best (similarity, start, words, hamming) in a whole text."""
        words = words_of(text)
        windows: dict[tuple[int, int], set[int]] = {}  # with the items they are windows of
        hashes: dict[int, np.ndarray] = {}
        for size, (sorted_h, at, item) in self.places.items():
            if len(words) < size:
                continue
            h = hashes[size] = window_hashes(words, size)
            lo = np.searchsorted(sorted_h, h)
            hit = np.flatnonzero(sorted_h[np.minimum(lo, len(sorted_h) - 1)] == h)
            for p in hit.tolist():
                j = int(lo[p])
                while j < len(sorted_h) and sorted_h[j] == h[p]:
                    n = int(self.lengths[item[j]])
                    start = min(max(p - int(at[j]), 0), max(len(words) - n, 0))
                    windows.setdefault((start, n), set()).add(int(item[j]))
                    j += 1
        best: dict[int, tuple] = {}
        for (start, n), of in windows.items():
            size = min(SHINGLE, n)
            own = hashes[size][start: start + max(n - size, 0) + 1]
            mark = simhash(own, self.weights(own))
            for k in of.intersection(self.within(mark)):
                s = self.similarity(k, own)
                if s >= threshold:
                    got = (s, -start, min(n, len(words)), int(hamming(self.prints[k: k + 1], mark)[0]))
                    best[k] = max(best.get(k, got), got)
        return best


def _shared(batches):
    for pdf in batches:
        hashes = [np.unique(window_hashes(words_of(t), SHINGLE)).astype(np.int64) for t in pdf["text"]]
        yield pd.DataFrame({"hash": np.concatenate([np.empty(0, np.int64), *hashes])})


def _weights(items: DataFrame) -> Weights:
    """Over all items: how many have words, and how many have each shingle that several have."""
    worded = items.select("text").mapInPandas(
        lambda batches: (pd.DataFrame({"n": [sum(bool(words_of(t)) for t in pdf["text"])]}) for pdf in batches), "n long")
    total = worded.agg(F.sum("n")).first()[0] or 0
    several = (items.select("text").mapInPandas(_shared, "hash long").groupBy("hash").agg(F.count("*").alias("n"))
               .filter("n > 1").toPandas())
    return Weights(total, several["hash"].to_numpy(np.int64).astype(np.uint64), several["n"].to_numpy(np.int64))


class Sent:
    """A broadcast block, and the weights, which are one broadcast for all blocks."""

    def __init__(self, tables, weights):
        self.tables, self.weights = tables, weights

    @property
    def value(self) -> Items:
        items = self.tables.value
        items.weights = self.weights.value
        return items


def _blocks(benchmark: DataFrame):
    """The broadcast lookup tables of each block of the distinct items, with the weights of all."""
    spark = benchmark.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    blocks = -(-items.count() // BLOCK)
    if not blocks:
        return
    weights = _weights(items)
    shared = spark.sparkContext.broadcast(weights)
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]
        tables = Items(rows, weights)
        tables.weights = None
        yield Sent(spark.sparkContext.broadcast(tables), shared)


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and benchmark item found in it, with the best window.

    docs (doc_id, text), benchmark (item_id, text).
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], MATCHES)
    for block, sent in enumerate(_blocks(benchmark)):
        def run(batches, sent=sent):
            items = sent.value
            for pdf in batches:
                out = []
                for doc_id, text in zip(pdf["doc_id"], pdf["text"]) if items.ids else ():
                    for k, (s, start, n, h) in sorted(items.search(text, threshold).items()):
                        out.append((doc_id, None if items.ids[k] is None else str(items.ids[k]), -start, n, h, s))
                got = pd.DataFrame(out, columns=["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"])
                yield got.assign(doc_id=ids_of(got["doc_id"]), item_id=ids_of(got["item_id"]))

        found = docs.select(id_text("doc_id").alias("doc_id"), "text").mapInPandas(run, MATCHES)
        out = found if block == 0 else out.unionByName(found)
    return out


def _holds(sent, threshold: float):
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(sent.value.search(t, threshold)) for t in texts], dtype=bool)

    return F.pandas_udf(run, "boolean")


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose text holds a benchmark item; the decision is taken where the row
    is, without a join, so ids do not matter and every column stays as it was."""
    for sent in _blocks(benchmark):
        docs = docs.filter(~_holds(sent, threshold)("text"))
    return docs
