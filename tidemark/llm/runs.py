"""Periodic runs of words: maximal pairs from a bottom-up LCP-interval tree.

A run is a stretch of words with smallest period q and at least ``max(MIN_WORDS, REPEATS * q)``
words that no neighbouring word extends keeping the period. If it starts at a and repeats every q
words, the suffixes at a and a + q agree in exactly L = length - q words, the words before them
differ and so do the words after: a *maximal pair*. Conversely a maximal pair (i, i + q) whose
common length L has L >= (REPEATS - 1) * q and L + q >= MIN_WORDS is the whole run from i to
i + q + L, so nothing has to be extended. A stretch found with several periods keeps the smallest.

Per document, with m positions whose ``SEED``-word window occurs again (no others can start a pair):

1. windows are ranked by prefix doubling (SEED words, then twice as long, until all differ),
   which sorts the suffixes; longest common prefixes of neighbours follow from the kept ranks;
2. a stack walks the LCP intervals bottom-up. An interval holds its positions in order and the
   left word they have in common, if there is one (the class list of a single left word). Joining
   two children of an interval looks from each position of the smaller list at its two neighbours
   in the larger one: pairs of different children agree in exactly the interval's depth. Children
   of one and the same left-word class hold no maximal pair and are only merged. The start a of a
   run and a + q are neighbours there: a position between them would give a smaller period.

Each position moves O(log m) times, so a document of n words, one line repeated, costs O(n log^2 n);
memory follows the longest text, never a group of documents. Rows are independent: no shuffle.

Null and empty texts have no words and no runs; repeated rows give repeated results; a null id is
kept. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import id_of, id_text, ids_of
from tidemark.llm.words import window_hashes

MIN_WORDS = 6
REPEATS = 4
SEED = MIN_WORDS - 1  # a pair of period 1 agrees in so many words at least, one of a longer period in more
OUT = 2000  # rows handed back at a time

RUNS = "array<struct<start: long, length: long, period: long>>"
Run = tuple[int, int, int]
Edit = Callable[[int | None, list[bytes]], list[bytes]]


def words_as_written(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8, letters as they are."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def _repeated(words: list[bytes]) -> np.ndarray:
    """Positions whose SEED-word window may occur again (equal windows have equal hashes)."""
    if len(words) <= SEED:
        return np.empty(0, np.int64)
    h = window_hashes(words, SEED)
    by = np.argsort(h, kind="stable")
    same = h[by[1:]] == h[by[:-1]]
    return np.sort(by[np.r_[False, same] | np.r_[same, False]])


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs of non-negative numbers."""
    return np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)[1].ravel()


def _suffixes(words: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions ``at`` in suffix order, and how many words each shares with the next."""
    n, nos = len(words), {}
    ids = np.fromiter((nos.setdefault(w, len(nos)) for w in words), np.int64, n)
    ids = np.append(ids, len(nos))  # the end differs from every word, and goes on for ever
    every = np.arange(n + 1)
    rank = ids
    for k in range(1, SEED):
        rank = _ranks(rank, ids[np.minimum(every + k, n)])
    width, levels = SEED, [(SEED, rank)]
    while rank.max() < n:  # some windows are still alike
        rank = _ranks(rank, rank[np.minimum(every + width, n)])
        width *= 2
        levels.append((width, rank))
    order = at[np.argsort(rank[at], kind="stable")]
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), np.int64)
    for width, rank in reversed(levels):
        common += width * (rank[a + common] == rank[b + common])
    going = np.ones(len(a), bool)
    for _ in range(SEED - 1):
        going &= ids[np.minimum(a + common, n)] == ids[np.minimum(b + common, n)]
        common += going
    return order, common


class _Interval:
    """Positions of one LCP interval: ascending, with the left word they share (None: several)."""

    __slots__ = ("places", "left")

    def __init__(self, place: int, left: int):
        self.places, self.left = [place], left


def _join(a: _Interval, b: _Interval, depth: int, left: list[int], found: dict) -> _Interval:
    """Merges two children of the interval of ``depth`` and notes the maximal pairs between them."""
    small, large = (a, b) if len(a.places) < len(b.places) else (b, a)
    mixed = a.left is None or b.left is None or a.left != b.left
    places, most = large.places, depth // (REPEATS - 1)
    dense = 8 * len(small.places) > len(places)
    for x in small.places:
        k = bisect_left(places, x)
        if mixed:
            for y in (places[k - 1] if k else -1, places[k] if k < len(places) else -1):
                q = abs(x - y)
                if y >= 0 and q <= most and depth + q >= MIN_WORDS and left[x] != left[y]:
                    run = (min(x, y), depth + q)
                    found[run] = min(q, found.get(run, q))
        if not dense:
            places.insert(k, x)
    if dense:
        places += small.places
        places.sort()  # two ascending stretches: one merge
    if mixed:
        large.left = None
    return large


def find_runs(words: list[bytes]) -> list[Run]:
    """All runs (start, length, period) of a word sequence, by start, then period."""
    at = _repeated(words)
    if not len(at):
        return []
    order, common = _suffixes(words, at)
    nos: dict[bytes, int] = {}
    left = [-1, *(nos.setdefault(w, len(nos)) for w in words[:-1])]
    stack: list[tuple[int, _Interval]] = []
    found: dict[tuple[int, int], int] = {}
    for place, depth in zip(order.tolist(), [*common.tolist(), 0]):
        own = _Interval(place, left[place])
        while stack and stack[-1][0] > depth:
            below, done = stack.pop()
            own = _join(done, own, below, left, found)
        if depth < SEED:
            continue  # shallower intervals hold no long enough pair
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, _join(stack[-1][1], own, depth, left, found))
        else:
            stack.append((depth, own))
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of docs(doc_id, text).

    runs: array of (start, length, period) by start, then period; collapsed: the text without
    repetitions, its words joined by one space. ``edit`` may replace the words of a row first.
    """
    def run(batches):
        out = []
        for pdf in batches:
            for doc, text in zip(pdf["id"], pdf["text"]):
                words = words_as_written(text)
                if edit:
                    words = edit(id_of(doc), words)
                runs = find_runs(words)
                out.append((doc, len(words), [dict(zip(("start", "length", "period"), r)) for r in runs],
                            b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")))
                if len(out) == OUT:
                    yield _frame(out)
                    out = []
        if out:
            yield _frame(out)

    return docs.select(id_text("doc_id").alias("id"), "text").mapInPandas(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "n_words", "runs", "collapsed"])
    out["doc_id"] = ids_of(out["doc_id"])
    return out


def digests(found: DataFrame) -> DataFrame:
    """One row per document of ``periodic_runs``: number of runs, the run with the greatest exact
    exponent (ties: smallest start, then period; nulls without a run), digests of all runs and of
    the collapsed text."""
    # a/b > c/d as a*d > c*b in decimals: doubles could tie where fractions differ
    def wide(c):
        return c.cast("decimal(19,0)")

    def better(x, y):
        a, b = wide(x["length"]) * wide(y["period"]), wide(y["length"]) * wide(x["period"])
        return F.when(a > b, x).otherwise(y)  # runs come by start, then period: later ones win only if greater

    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.element_at("runs", 1),
                       lambda kept, x: better(x, kept))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    got = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                       F.when(F.size("runs") > 0, best).alias("best"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return got.select("doc_id", "n_runs", *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
                      F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")
