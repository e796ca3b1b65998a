"""Toxicity: a convolutional text classifier trained in numpy, thresholds calibrated by language.

Words (runs of letters, lower-cased) are hashed into ``BUCKETS`` rows, whole and by their first
``STEM`` characters. A word's embedding has ``DIM`` trained coordinates (the sum of both rows) and
two fixed ones: the shrunken log-odds of label 1 of its whole-word and its stem bucket. Filters of
the widths ``WIDTHS`` slide over the whole text; each keeps its maximum, and a logistic layer
weighs the maxima. Texts are read whole, in slices that overlap by the widest filter.

Training: every labelled row outside the held-out fold, with its whole text, as stored word numbers.
Log-odds are counted in Spark and cross-fitted (a row sees those of the other folds). The rest is
trained in ``EPOCHS`` rounds: each shard of about ``SHARD_ROWS`` rows goes on from the round's model in
a task of its own, and Spark averages what the shards changed (a word's coordinates over the shards
that met it), so the driver holds one model whatever the input. Gradients flow through the maxima to
a few words of each text. Every ``CALIBRATE``-th row is kept from training to set the thresholds from
counts by logit (steps of 1 / ``STEPS``): for each language with enough such rows of both labels its
own, a pooled one for all others. A text's language (one of the ``MAX_LANGS`` most frequent) is
inferred from its words (naive Bayes over the same buckets, counted on all these rows), never read
from a column. The score is the logistic of the distance to the threshold, so 0.5 is the threshold.

Scoring is one pass over the rows without a shuffle. Null and empty texts, and texts without
a letter, have no words: all maxima are zero and they get the score of that, below 0.5 unless
only label 1 was ever seen. Ids with contradicting labels and null ids teach nothing; a null id
counts as the empty text for the folds. Without rows of both labels the score is the share of label
1 among the rows learned from (0 without any).
"""

from __future__ import annotations

import copy
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.langid import held_out
from tidemark.llm.rows import id_text, ids_of
from tidemark.llm.scratch import release_shuffles, stored

BUCKETS = 1 << 15
DIM = 14
STEM = 4
WIDTHS = (1, 2, 3)
FILTERS = 12
SHARD_ROWS = 4096  # training rows of a shard
SENT_IDS = 2_000_000  # ids that a broadcast may hold
STEPS = 256  # logits told apart per unit when thresholds are set
FOLDS, FOLD = 5, 0
CALIBRATE = 4
MAX_LANGS = 64  # languages told apart, the most frequent of the rows learned from
LEAST = 12  # calibration rows of each label for a threshold of a language's own
PRIOR_ROWS = 8.0  # rows of average label that every bucket is taken to have been seen in
EPOCHS, BATCH, RATE = 6, 16, 0.02
SLICE = 1 << 17  # words scored at once

_WORD = re.compile(r"[^\W\d_]+")
_PAD = max(WIDTHS) - 1
_EXTRA = 2


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class _Numbers(dict):
    """word -> (bucket, stem bucket) as one number; computed once per distinct word."""

    def __missing__(self, word: str) -> int:
        whole = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
        stem = xxhash.xxh3_64_intdigest(b"^" + word[:STEM].encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
        got = whole * BUCKETS + stem
        if len(self) < 1 << 20:  # what is kept is bounded, results are not affected
            self[word] = got
        return got

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class Model:
    """Arrays of bounded size: all that is broadcast."""

    constant: float | None  # the score of every text where nothing can be learned
    odds: np.ndarray  # (2, BUCKETS) log-odds of whole words and of stems
    table: np.ndarray  # (2, BUCKETS, DIM)
    filters: list[np.ndarray]  # per width (width, DIM + 2, FILTERS)
    bias: list[np.ndarray]
    top: np.ndarray
    top_bias: float
    langs: list[str]
    lang_logs: np.ndarray  # (BUCKETS, languages)
    thresholds: np.ndarray  # per language, then the pooled one

    def embed(self, numbers: np.ndarray, odds: np.ndarray | None = None) -> np.ndarray:
        """(words, DIM + 2); ``odds`` replaces the log-odds while training."""
        odds = self.odds if odds is None else odds
        whole, stem = numbers // BUCKETS, numbers % BUCKETS
        return np.concatenate([self.table[0][whole] + self.table[1][stem], odds[0][whole][:, None], odds[1][stem][:, None]],
                              1, dtype=np.float32)

    def responses(self, x: np.ndarray) -> list[np.ndarray]:
        """Per width, the filters' values at each of the first len(x) - _PAD places."""
        n = len(x) - _PAD
        return [sum(x[t: t + n] @ w[t] for t in range(len(w))) + b for w, b in zip(self.filters, self.bias)]

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.top + self.top_bias

    def language(self, sums: np.ndarray) -> np.ndarray:
        return sums.argmax(1) if len(self.langs) else np.zeros(len(sums), np.int64)


def _lang_sums(model: Model, numbers: np.ndarray) -> np.ndarray:
    return model.lang_logs[numbers // BUCKETS].sum(0, dtype=np.float64)


def _pool(model: Model, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, filters) maxima over whole texts and (texts, languages) summed log-probabilities."""
    pooled = np.zeros((len(texts), FILTERS * len(WIDTHS)), np.float32)  # filters count from zero up
    langs = np.zeros((len(texts), len(model.langs)))
    pad = np.zeros((_PAD, DIM + _EXTRA), np.float32)
    held, owners, size = [], [], 0

    def flush():
        x = np.concatenate([part for e in held for part in (model.embed(e[0]), model.embed(e[1]), pad[len(e[1]):])] + [pad])
        lengths = np.array([len(e[0]) for e in held])
        starts = np.cumsum(lengths + _PAD) - (lengths + _PAD)
        edges = np.stack([starts, starts + lengths], 1).ravel()
        best = np.concatenate([np.maximum.reduceat(r, edges)[::2] for r in model.responses(x)], 1)
        np.maximum.at(pooled, owners, best)
        if model.langs:
            for o, e in zip(owners, held):
                langs[o] += _lang_sums(model, e[0])

    for i, numbers in enumerate(texts):
        for at in range(0, len(numbers), SLICE):  # a slice sees the first words of the next one
            held.append((numbers[at: at + SLICE], numbers[at + SLICE: at + SLICE + _PAD]))
            owners.append(i)
            size += len(held[-1][0])
            if size >= SLICE:
                flush()
                held, owners, size = [], [], 0
    if held:
        flush()
    return pooled, langs


def score_texts(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    pooled, langs = _pool(model, texts)
    limit = model.thresholds[model.language(langs)] if model.langs else model.thresholds[-1]
    return 1 / (1 + np.exp(-np.clip(model.logit(pooled) - limit, -500, 500)))


# ---- training ----------------------------------------------------------------------------

def _log_odds(seen: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    rate = (toxic + PRIOR_ROWS * share) / (seen + PRIOR_ROWS)
    return np.log(rate / (1 - rate)) - np.log(share / (1 - share))


def _document_counts(texts: list[np.ndarray], y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """(FOLDS, seen/toxic, whole/stem, BUCKETS): documents of each fold with each bucket."""
    out = np.zeros((FOLDS, 2, 2, BUCKETS))
    for numbers, label, f in zip(texts, y, fold):
        for k, b in enumerate((np.unique(numbers // BUCKETS), np.unique(numbers % BUCKETS))):
            out[f, 0, k, b] += 1
            out[f, 1, k, b] += label
    return out


def _maxima(model: Model, numbers: np.ndarray, odds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each filter's maximum over a whole text, and per width the places of the maxima; a slice at a time."""
    best, places = np.full(FILTERS * len(WIDTHS), -np.inf, np.float32), np.zeros((len(WIDTHS), FILTERS), np.int64)
    for start in range(0, len(numbers), SLICE):
        part = model.embed(numbers[start: start + SLICE + _PAD], odds)
        ends = np.zeros((min(SLICE, len(numbers) - start) + _PAD - len(part), DIM + _EXTRA), np.float32)
        for k, r in enumerate(model.responses(np.concatenate([part, ends]))):
            at = r.argmax(0)
            value, old = r[at, np.arange(FILTERS)], best[k * FILTERS: (k + 1) * FILTERS]
            places[k] = np.where(value > old, at + start, places[k])
            old[:] = np.maximum(value, old)
    return best, list(places)


def _step(model: Model, batch: list, odds: np.ndarray, y: np.ndarray, state: dict) -> None:
    """One update from a batch of (numbers, fold): only the maxima's words get a gradient."""
    found = [_maxima(model, numbers, odds[f]) for numbers, f in batch]
    pooled = np.array([values for values, _ in found])
    h = np.maximum(pooled, 0)
    error = 1 / (1 + np.exp(-np.clip(h @ model.top + model.top_bias, -50, 50))) - y
    error /= len(batch)
    back = (error[:, None] * model.top) * (pooled > 0)  # (rows, all filters)
    grads = {"top": h.T @ error, "top_bias": np.array([error.sum()])}
    touched, pulls = [], []
    for k, width in enumerate(WIDTHS):
        own = slice(k * FILTERS, (k + 1) * FILTERS)
        grads[f"filters{k}"], grads[f"bias{k}"] = np.zeros_like(model.filters[k]), back[:, own].sum(0)
        for (numbers, f), (_, at), g in zip(batch, found, back[:, own]):
            for t in range(width):
                inside = np.flatnonzero(at[k] + t < len(numbers))
                grads[f"filters{k}"][t][:, inside] += (model.embed(numbers[at[k][inside] + t], odds[f]) * g[inside, None]).T
                touched.append(numbers[at[k][inside] + t])
                pulls.append(g[inside, None] * model.filters[k][t][:DIM, inside].T)
    state["n"] += 1

    def adam(name, value):
        m, v = state.setdefault(name, [np.zeros_like(value), np.zeros_like(value)])
        g = grads[name]
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        n = state["n"]
        return value - RATE * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)

    model.top, model.top_bias = adam("top", model.top), float(adam("top_bias", np.array([model.top_bias]))[0])
    for k in range(len(WIDTHS)):
        model.filters[k] = adam(f"filters{k}", model.filters[k]).astype(np.float32)
        model.bias[k] = adam(f"bias{k}", model.bias[k]).astype(np.float32)
    numbers, pull = np.concatenate(touched), np.concatenate(pulls)
    for table, past, bucket in ((model.table[0], state["past"][0], numbers // BUCKETS), (model.table[1], state["past"][1], numbers % BUCKETS)):
        rows, at = np.unique(bucket, return_inverse=True)
        g = np.zeros((len(rows), DIM))
        np.add.at(g, at, pull)
        past[rows] += (g * g).sum(1)
        table[rows] -= (RATE * g / np.sqrt(past[rows] + 1e-6)[:, None]).astype(np.float32)


def best_threshold(logits: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the gap between neighbouring logits at which the weighted F1 is greatest."""
    order = np.argsort(-logits, kind="stable")
    z, hit, w = logits[order], y[order], weights[order]
    caught, taken = np.cumsum(hit * w), np.cumsum(w)
    f1 = 2 * caught / (taken + (y * weights).sum())
    f1[:-1][z[1:] == z[:-1]] = -1  # equal logits stay together
    k = int(f1.argmax())
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k]) - 1


def _empty() -> Model:
    return Model(None, np.zeros((2, BUCKETS)), np.zeros((2, BUCKETS, DIM), np.float32), [], [], np.zeros(FILTERS * len(WIDTHS)), 0.0,
                 [], np.zeros((BUCKETS, 0), np.float32), np.zeros(1))


def _begin(model: Model, counts: np.ndarray, share: float, rng: np.random.Generator) -> list[np.ndarray]:
    """Sets what training starts from; the log-odds that the rows of each fold see."""
    odds = [np.stack([_log_odds(c[0, k], c[1, k], share) for k in (0, 1)]) for c in counts.sum(0) - counts]
    model.odds = np.stack([_log_odds(*counts.sum(0)[:, k], share) for k in (0, 1)])
    model.table = rng.normal(0, 0.1, model.table.shape).astype(np.float32)
    model.filters = [rng.normal(0, 0.2, (w, DIM + _EXTRA, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in model.filters:
        w[0, DIM:] = np.abs(w[0, DIM:])  # the fixed coordinates start as evidence for label 1
    model.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    model.top = rng.normal(0, 0.2, FILTERS * len(WIDTHS))
    return odds


def fit(texts: list[np.ndarray], y: np.ndarray, langs: list[str | None], clean_weight: float = 1.0) -> Model:
    """``train`` on rows in memory. texts: word numbers of each row; the order of the rows decides folds and batches."""
    model = _empty()
    if len(y) == 0 or y.min() == y.max():
        model.constant = float(y.mean()) if len(y) else 0.0
        return model
    rng = np.random.default_rng(13)
    keep, fold = np.ones(len(y), bool), np.zeros(len(y), np.int64)
    for label in (0, 1):  # both labels in all folds, and among the rows kept for the thresholds
        own = np.flatnonzero(y == label)
        keep[own[CALIBRATE - 1:: CALIBRATE]] = False
        fold[own] = np.arange(len(own)) // CALIBRATE % FOLDS
    keep, rest = np.flatnonzero(keep), np.flatnonzero(~keep)
    counts = _document_counts([texts[i] for i in keep], y[keep], fold[keep])
    share = float(np.clip(y[keep].mean(), 0.01, 0.99))
    odds = _begin(model, counts, share, rng)
    state = {"n": 0, "past": np.zeros((2, BUCKETS))}
    rows = np.array([i for i in keep if len(texts[i])], np.int64)
    for _ in range(EPOCHS if len(rows) else 0):
        at = rng.permutation(rows)
        for b in range(0, len(at), BATCH):
            own = at[b: b + BATCH]
            _step(model, [(texts[i], fold[i]) for i in own], odds, y[own], state)
    _calibrate(model, [texts[i] for i in rest], y[rest], [langs[i] for i in rest], texts, langs, clean_weight)
    return model


def _calibrate(model: Model, texts, y, langs, every, every_lang, clean_weight: float) -> None:
    """Thresholds from the rows kept from training; ``every``: all rows, whose languages are learned."""
    seen = Counter(x for x in every_lang if x)
    model.langs = sorted(sorted(seen, key=lambda x: (-seen[x], x))[:MAX_LANGS])
    sums = np.ones((BUCKETS, len(model.langs)))
    for numbers, lang in zip(every, every_lang):
        if lang in model.langs:
            np.add.at(sums[:, model.langs.index(lang)], numbers // BUCKETS, 1)
    model.lang_logs = np.log(sums / sums.sum(0)).astype(np.float32)
    model.thresholds = np.zeros(len(model.langs) + 1)
    if not len(y):
        return
    pooled, lang_sums = _pool(model, texts)
    z, weight, inferred = model.logit(pooled), np.where(y == 1, 1.0, clean_weight), model.language(lang_sums)
    model.thresholds[:] = best_threshold(z, y, weight)
    for k in range(len(model.langs)):
        own = inferred == k
        if min(np.count_nonzero(y[own] == label) for label in (0, 1)) >= LEAST:
            model.thresholds[k] = best_threshold(z[own], y[own], weight[own])


def taught(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, place) of every labelled id to learn from; place numbers the ids of a label, by
    hashed slots, so that no task numbers them all."""
    rows = stored(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
                  .filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id"), FOLDS, FOLD))
                  .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most")
                  .select("doc_id", "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(1024)).cast("int").alias("slot")))
    before = F.sum("count").over(Window.partitionBy("toxic").orderBy("slot")) - F.col("count")
    slots = rows.groupBy("toxic", "slot").count().select("toxic", "slot", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("toxic", "slot").orderBy("doc_id"))
    return stored(rows.withColumn("rank", rank).join(F.broadcast(slots), ["toxic", "slot"])
                  .select("doc_id", "toxic", (F.col("before") + F.col("rank") - 1).alias("place")))


def learned(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, place, lang, numbers) of every labelled row with a text, stored; numbers: its words as
    32-bit integers. One row of a repeated id. Texts are never shuffled: up to ``SENT_IDS`` ids are sent
    to the documents, with more of them all documents are cut into words before the join."""
    def run(batches):
        known = _Numbers()
        for pdf in batches:
            pdf["numbers"] = [known.of(words_of(t)).astype(np.int32).tobytes() for t in pdf["text"]]
            yield pdf.drop(columns="text")

    ids = taught(labels)
    few = ids.count() <= SENT_IDS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.xxhash64("text").alias("h"), "text").filter("text is not null and doc_id is not null")
    if few:
        rows = rows.join(F.broadcast(ids), "doc_id")
    more = ", toxic int, place long" if few else ""
    rows = rows.mapInPandas(run, f"doc_id long, lang string, h long{more}, numbers binary")
    if not few:
        rows = rows.join(ids, "doc_id")
    own = F.min(F.struct("h", "lang", "numbers")).alias("t")
    return stored(rows.groupBy("doc_id", "toxic", "place").agg(own).select("toxic", "place", "t.lang", "t.numbers"))


_KEPT = f"place % {CALIBRATE} != {CALIBRATE - 1}"


def _numbers(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.int32).astype(np.int64)


def _fold(place: int) -> int:
    return place // CALIBRATE % FOLDS


def _counts(rows: DataFrame, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Documents by fold, label and bucket of the rows to train on, words by bucket and language of all rows."""
    def run(batches):
        docs, words = np.zeros((FOLDS, 2, 2, BUCKETS), np.int64), np.zeros((len(langs), BUCKETS), np.int64)
        for pdf in batches:
            for toxic, place, lang, value in zip(pdf["toxic"], pdf["place"], pdf["lang"], pdf["numbers"]):
                numbers = _numbers(value)
                if place % CALIBRATE != CALIBRATE - 1:
                    for k, b in enumerate((np.unique(numbers // BUCKETS), np.unique(numbers % BUCKETS))):
                        docs[_fold(place), 0, k, b] += 1
                        docs[_fold(place), 1, k, b] += toxic
                if lang in langs:
                    words[langs.index(lang)] += np.bincount(numbers // BUCKETS, minlength=BUCKETS)
        table = np.concatenate([docs.reshape(-1, BUCKETS), words])
        yield pd.DataFrame({"key": np.arange(len(table)), "n": [r.tobytes() for r in table]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, n = 0, np.zeros(BUCKETS, np.int64)
        for pdf in batches:
            for key, value in zip(pdf["key"], pdf["n"]):
                n = n + np.frombuffer(value, np.int64)
        yield pd.DataFrame({"key": [key], "n": [n.tobytes()]})

    got = np.zeros((4 * FOLDS + len(langs), BUCKETS), np.int64)
    schema = "key long, n binary"
    for r in rows.mapInPandas(run, schema).groupBy("key").applyInPandas(add, schema).toLocalIterator():
        got[r["key"]] = np.frombuffer(r["n"], np.int64)
    return got[: 4 * FOLDS].reshape(FOLDS, 2, 2, BUCKETS).astype(float), got[4 * FOLDS:]


_PIECES = 16


def _state(past: np.ndarray) -> dict:
    """What ``_step`` carries on: steps taken, squared gradients of words, two moments of all else."""
    shapes = {"top": (FILTERS * len(WIDTHS),), "top_bias": (1,)}
    shapes |= {f"filters{k}": (w, DIM + _EXTRA, FILTERS) for k, w in enumerate(WIDTHS)} | {f"bias{k}": (FILTERS,) for k in range(len(WIDTHS))}
    return {"n": 0, "past": past} | {name: [np.zeros(shape), np.zeros(shape)] for name, shape in shapes.items()}


def _dense(model: Model, state: dict) -> np.ndarray:
    """All that is trained but the words, and its moments."""
    moments = [x for name in state if name not in ("n", "past") for x in state[name]]
    return np.concatenate([np.ravel(v) for v in (*model.filters, *model.bias, model.top, [model.top_bias], *moments)])


def _put_dense(model: Model, state: dict, flat: np.ndarray) -> None:
    at = 0

    def take(old):
        nonlocal at
        at += old.size
        return flat[at - old.size: at].reshape(old.shape).astype(old.dtype)

    model.filters, model.bias = [take(w) for w in model.filters], [take(b) for b in model.bias]
    model.top, model.top_bias = take(model.top), float(take(np.zeros(1))[0])
    for name in state:
        if name not in ("n", "past"):
            state[name] = [take(x) for x in state[name]]


def _words(model: Model, past: np.ndarray) -> np.ndarray:
    """(2 * BUCKETS, DIM + 1): the coordinates of words and of stems, and their summed squared gradients."""
    return np.concatenate([model.table, past[:, :, None]], 2, dtype=np.float32).reshape(2 * BUCKETS, -1)


def _round(rows: DataFrame, model: Model, odds: list[np.ndarray], state: dict, shards: int, epoch: int) -> None:
    """One pass of all shards over their rows; model and state are changed by the mean of what they changed."""
    sent = rows.sparkSession.sparkContext.broadcast((model, odds, state))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True).sort_values(["place", "toxic"])
        own, seen, mine = copy.deepcopy(sent.value)
        texts, fold, y = [_numbers(v) for v in pdf["numbers"]], [_fold(p) for p in pdf["place"]], pdf["toxic"].to_numpy(np.int64)
        before = _words(own, mine["past"]), _dense(own, mine)
        at = np.random.default_rng([13, epoch, int(pdf["shard"].iloc[0])]).permutation(np.array([i for i, t in enumerate(texts) if len(t)], np.int64))
        for b in range(0, len(at), BATCH):
            _step(own, [(texts[i], fold[i]) for i in at[b: b + BATCH]], seen, y[at[b: b + BATCH]], mine)
        change = np.split(_words(own, mine["past"]) - before[0], _PIECES)
        yield pd.DataFrame({"piece": np.arange(_PIECES + 1), "change": [c.tobytes() for c in (*change, (_dense(own, mine) - before[1]).astype(np.float32))]})

    def mean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece, total, n = 0, 0.0, 0
        for pdf in batches:
            for piece, value in zip(pdf["piece"], pdf["change"]):
                one = np.frombuffer(value, np.float32).astype(float)
                one = one if piece == _PIECES else one.reshape(-1, DIM + 1)
                total, n = total + one, n + (1 if piece == _PIECES else one[:, -1:] > 0)
        yield pd.DataFrame({"piece": [piece], "change": [(total / np.maximum(n, 1)).astype(np.float32).tobytes()]})

    schema = "piece long, change binary"
    dealt = rows.withColumn("shard", F.pmod("place", F.lit(shards))).groupBy("shard").applyInPandas(run, schema)
    got = {r["piece"]: np.frombuffer(r["change"], np.float32) for r in dealt.groupBy("piece").applyInPandas(mean, schema).collect()}
    _put_dense(model, state, _dense(model, state) + got[_PIECES])
    words = (_words(model, state["past"]) + np.concatenate([got[k] for k in range(_PIECES)]).reshape(2 * BUCKETS, -1)).reshape(2, BUCKETS, -1)
    model.table, state["past"] = np.ascontiguousarray(words[:, :, :DIM], np.float32), words[:, :, DIM].astype(float)
    sent.destroy()
    release_shuffles(rows.sparkSession)


def _thresholds(model: Model, rows: DataFrame) -> np.ndarray:
    """Per language, then pooled, from counts of the rows kept from training by inferred language, logit and label."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for pdf in batches:
            pooled, sums = _pool(sent.value, [_numbers(v) for v in pdf["numbers"]])
            step = np.rint(np.clip(sent.value.logit(pooled), -500, 500) * STEPS).astype(np.int64)
            yield pd.DataFrame({"lang": sent.value.language(sums), "step": step, "toxic": pdf["toxic"]})

    got = rows.mapInPandas(run, "lang long, step long, toxic int").groupBy("lang", "step", "toxic").count().toPandas()
    out = np.zeros(len(model.langs) + 1)
    if len(got):
        z, y, weight = got["step"].to_numpy() / STEPS, got["toxic"].to_numpy(), got["count"].to_numpy(float)
        out[:] = best_threshold(z, y, weight)
        for k in range(len(model.langs)):
            own = got["lang"].to_numpy() == k
            if min(weight[own & (y == label)].sum() for label in (0, 1)) >= LEAST:
                out[k] = best_threshold(z[own], y[own], weight[own])
    return out


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows, model = learned(docs, labels), _empty()
    total = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(total) < 2:
        model.constant = float(1 in total)
        return model
    common = rows.filter("lang != ''").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    model.langs = sorted(r["lang"] for r in common)
    kept = rows.filter(_KEPT)
    seen = {r["toxic"]: r["count"] for r in kept.groupBy("toxic").count().collect()}
    counts, words = _counts(rows, model.langs)
    n = sum(seen.values())
    odds = _begin(model, counts, float(np.clip(seen.get(1, 0) / max(n, 1), 0.01, 0.99)), np.random.default_rng(13))
    sums = (words + 1).T.astype(float)
    model.lang_logs = np.log(sums / sums.sum(0)).astype(np.float32)
    state, shards = _state(np.zeros((2, BUCKETS))), -(-n // SHARD_ROWS)
    for epoch in range(EPOCHS if n else 0):
        state["n"] = epoch * (n // (shards * BATCH))
        _round(kept, model, odds, state, shards, epoch)
    model.thresholds = _thresholds(model, rows.filter(f"not ({_KEPT})"))
    return model


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs(doc_id, text, lang), learning from
    the labelled rows outside the held-out fold."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches):
        numbers = _Numbers()
        for pdf in batches:
            got = np.empty(len(pdf))
            texts, at, size = [], 0, 0
            for i, text in enumerate(pdf["text"]):
                texts.append(numbers.of(words_of(text)))
                size += len(texts[-1])
                if size >= 4 * SLICE or i + 1 == len(pdf):
                    got[at: i + 1] = score_texts(sent.value, texts)
                    texts, at, size = [], i + 1, 0
            yield pd.DataFrame({"doc_id": ids_of(pdf["id"]), "held_out": pdf["held_out"], "score": got,
                                "predicted": (got >= 0.5).astype(np.int32)})

    return docs.select(id_text("doc_id").alias("id"), held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "text").mapInPandas(
        run, "doc_id long, held_out boolean, score double, predicted int")
