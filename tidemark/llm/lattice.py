"""Language-model scores: marginal likelihood of a text over all its subword segmentations.

A unigram model over the pieces of a public subword vocabulary and one end token: the
probability of a word is the sum over all ways to cut it into pieces, by a forward recursion
in log space; that of a text is the product over its words and the end (pieces never span
white space, so the lattice of a text falls apart at its words and each distinct word is
computed once). A piece weighs ``1 - PRIOR`` times its share among the pieces of the training
words (as the vocabulary's own tokenizer cuts them) plus ``PRIOR`` times a Zipf-Mandelbrot
law over the rank that the vocabulary's own scores give. Characters without a piece go
through the byte pieces, so every text has a finite score.

The word counts of the training texts are summed per chunk first and then by word (see
``chunks``), and each distinct word's marginal is computed where its counts meet; per-piece
counts (as many as the vocabulary) are all that reaches the driver.

Null texts count as empty: one end token. Without training texts N is 0 and V is 0.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks
from tidemark.llm.langid import held_out
from tidemark.llm.words import words_of

MODEL = "piece_bpe_32k.model"
PRIOR = 0.05
FOLDS, FOLD = 5, 1
_N, _V = -1, -2  # in the counts beside piece ids


@lru_cache(4)
def _tokenizer(path: str | None):
    import public_tokenizers as public
    return sentencepiece.SentencePieceProcessor(model_file=path or public.path(MODEL))


def _totals(entries: list) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
    """Distinct words of all entries, their summed counts, and each entry's places among them."""
    nos: dict[bytes, int] = {}
    at = [np.fromiter((nos.setdefault(w, len(nos)) for w in words), np.int64, len(words)) for words, _ in entries]
    total = np.zeros(len(nos), np.int64)
    for places, (_, counts) in zip(at, entries):
        total[places] += counts  # a chunk has each word once
    return list(nos), total, at


def _count_pieces(path):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sp = _tokenizer(path)
        words, n, _ = _totals([(chunks.unpack_words(w), chunks.unpack(c)) for w, c in zip(pdf["words"], pdf["counts"])])
        known = np.flatnonzero(n)
        cut = sp.encode([words[i].decode("utf-8", "replace") for i in known], num_threads=1)
        flat = np.fromiter((i for x in cut for i in x), np.int64)
        counts = np.bincount(flat, np.repeat(n[known], [len(x) for x in cut]), minlength=sp.vocab_size())
        at = np.flatnonzero(counts)
        return pd.DataFrame({"piece": np.append(at, [_N, _V]), "n": np.append(counts[at], [n.sum(), len(known)]).astype(np.int64)})
    return run


def piece_weights(counts: dict[int, int], n_end: int, path: str | None = None) -> tuple[dict[str, float], list[float], float]:
    """Log-probabilities: of pieces by text, of the 256 byte pieces, of the end token."""
    sp = _tokenizer(path)
    ids = [i for i in range(sp.vocab_size()) if not sp.is_control(i) and not sp.is_unknown(i) and sp.get_score(i) > -1e8]
    rank = {i: len(ids) if sp.is_byte(i) else -sp.get_score(i) for i in ids}
    zipf = {i: 1 / (r + 2.7) for i, r in rank.items()}
    mass, total = sum(zipf.values()), sum(counts.get(i, 0) for i in ids) + n_end
    keep = 1 - PRIOR if total else 0.0
    logs = {i: math.log(keep * counts.get(i, 0) / max(total, 1) + (1 - keep) * z / mass * (1 - 1e-6)) for i, z in zipf.items()}
    end = math.log(keep * n_end / max(total, 1) + (1 - keep) * 1e-6)
    one_byte = [logs[sp.piece_to_id(f"<0x{b:02X}>")] for b in range(256)]
    return {sp.id_to_piece(i): x for i, x in logs.items() if not sp.is_byte(i)}, one_byte, end


def marginal(word: str, logs: dict[str, float], one_byte: list[float], longest: int) -> float:
    """ln of the summed probability of all segmentations of a word (with its word mark)."""
    text = "▁" + word
    forward = [0.0]
    for j in range(1, len(text) + 1):
        terms = [forward[i] + logs[text[i:j]] for i in range(max(0, j - longest), j) if text[i:j] in logs]
        if text[j - 1] not in logs:  # through its bytes
            terms.append(forward[j - 1] + sum(one_byte[b] for b in text[j - 1].encode("utf-8", "surrogatepass")))
        top = max(terms)
        forward.append(top + math.log(sum(math.exp(t - top) for t in terms)) if len(terms) > 1 else top)
    return forward[-1]


def _word_scores(words: DataFrame, weights) -> DataFrame:
    """A dictionary -> (chunk, numbers, c, model): training counts and marginals of its words."""
    sent = words.sparkSession.sparkContext.broadcast(weights)

    def work(entries):
        logs, one_byte, _ = sent.value
        longest = max(map(len, logs))
        words, c, at = _totals(entries)
        model = np.array([marginal(w.decode("utf-8", "surrogatepass"), logs, one_byte, longest) for w in words]) / math.log(10)
        return [(chunks.pack(c[p]), model[p].astype("<f8").tobytes()) for p in at]

    return chunks.by_word(words, work, "c binary, model binary")


def _gather(rows: pd.DataFrame, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    c, model = np.empty(len(at), np.int64), np.empty(len(at))
    c[at] = np.concatenate([np.empty(0, np.int64), *map(chunks.unpack, rows["c"])])
    model[at] = np.concatenate([np.empty(0), *(np.frombuffer(x, "<f8") for x in rows["model"])])
    return c, model


def score(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per document."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                         (~held_out(F.col("doc_id"), FOLDS, FOLD)).alias("flag"))
    words = chunks.dictionary(marked, words_of, flagged_only=True)
    n_end = marked.filter("flag").count()
    counts = {r["piece"]: r["n"] for r in words.groupBy("part").applyInPandas(_count_pieces(path), "piece int, n long")
              .groupBy("piece").agg(F.sum("n").alias("n")).collect()}  # one row per piece of the vocabulary
    n_train, v = counts.pop(_N, 0) + n_end, counts.pop(_V, 0) + (n_end > 0)
    weights = piece_weights(counts, n_end, path)
    total = n_train + 0.5 * (v + 1)
    scored = _word_scores(words, weights)
    base_end, model_end = math.log10((n_end + 0.5) / total), weights[2] / math.log(10)

    def work(ids, flags, lengths, numbers, known):
        doc = np.repeat(np.arange(len(lengths)), lengths)

        def per_doc(x):
            return np.bincount(doc, x[numbers], minlength=len(lengths))

        c, model = known
        return pd.DataFrame({
            "doc_id": ids, "held_out": ~flags, "n_tokens": lengths + 1,
            "n_known": per_doc((c > 0).astype(float)).astype(np.int64) + (n_end > 0), "train_tokens": n_train,
            "base_score": per_doc(np.log10((c + 0.5) / total)) + base_end,
            "score": per_doc(model) + model_end})

    return chunks.paired(chunks.streams(marked, words_of, as_set=True), scored, _gather, work,
                         "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                         "base_score double, score double")
