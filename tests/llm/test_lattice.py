import collections
import math
import zlib

import pytest

from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD, odd_documents
from tidemark.llm import lattice
from tidemark.llm.words import words_of


def brute(rows):
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    c = collections.Counter(w for t in train for w in words_of(t))
    n, v, end = sum(c.values()) + len(train), len(c) + bool(train), len(train)
    p = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    out = []
    for i, t in rows:
        ws = words_of(t)
        out.append((i, len(ws) + 1, sum(c[w] > 0 for w in ws) + bool(end), n, sum(p(c[w]) for w in ws) + p(end)))
    return out


def check(got, rows):
    key = lambda r: (r[0] is not None, r[0] or 0)
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    want = sorted(brute(rows), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in want], rel=1e-9)


def test_base_scores_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = lattice.score(docs).collect()
    check(got, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(r["score"] < 0 for r in got)
    for extra in (False, True):
        check(lattice.score(odd_documents(spark, extra)).collect(), [r[:2] for r in ODD])
    assert lattice.score(odd_documents(spark).limit(0)).count() == 0


def test_marginal_sums_all_segmentations():
    logs = {"▁": -1.0, "▁a": -1.5, "a": -2.0, "b": -2.5, "ab": -1.2, "▁ab": -3.0}
    one_byte = [-4.0] * 256

    def paths(text):
        if not text:
            yield 0.0
        for k in range(1, len(text) + 1):
            if text[:k] in logs:
                yield from (logs[text[:k]] + x for x in paths(text[k:]))
        if text and text[0] not in logs:
            yield from (-4.0 * len(text[0].encode()) + x for x in paths(text[1:]))

    for word in ("ab", "aab", "b", "aé", "éé", ""):
        want = math.log(sum(map(math.exp, paths("▁" + word))))
        assert lattice.marginal(word, logs, one_byte, 3) == pytest.approx(want)


def test_weights_are_a_distribution():
    logs, one_byte, end = lattice.piece_weights({300: 5, 20000: 7}, 3)
    assert sum(map(math.exp, [*logs.values(), *one_byte, end])) == pytest.approx(1, abs=1e-3)


def test_document_scores_equal_brute_force(spark):
    """score of whole documents: piece counts, weights and the sum over all segmentations, computed anew."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()] + [
        (r[0] and r[0] + 1_000_000, r[1]) for r in ODD if r[0] != 7]
    sp = lattice._tokenizer(None)
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    words = collections.Counter(w.decode() for t in train for w in words_of(t))
    pieces = collections.Counter()
    for w, n in words.items():
        for k in sp.encode(w):
            pieces[k] += n
    logs, one_byte, end = lattice.piece_weights(dict(pieces), len(train))
    longest, memo = max(map(len, logs)), {}

    def total(text):  # from the front: the first piece, then the rest
        if not text:
            return 1.0, 0  # mantissa and binary exponent: probabilities far below the range of a double
        if text not in memo:
            terms = [(logs[text[:k]], total(text[k:])) for k in range(1, min(longest, len(text)) + 1) if text[:k] in logs]
            if text[0] not in logs:
                terms.append((sum(one_byte[b] for b in text[0].encode()), total(text[1:])))
            parts = [math.frexp(math.exp(x) * m) + (e,) for x, (m, e) in terms]
            top = max(a + e for m, a, e in parts)
            m, a = math.frexp(sum(math.ldexp(m, a + e - top) for m, a, e in parts))
            memo[text] = m, a + top
        return memo[text]

    def ln(text):
        m, e = total(text)
        return math.log(m) + e * math.log(2)

    want = {i: (sum(ln("▁" + w.decode()) for w in words_of(t) if len(w) < 800) + end) / math.log(10) for i, t in rows}
    short = {i for i, t in rows if all(len(w) < 800 for w in words_of(t))}
    got = lattice.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-9) for r in got if r["doc_id"] in short)
    assert len(short) > 50
