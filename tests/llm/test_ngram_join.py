import random

import numpy as np
import pytest

from tests.conftest import SF_MID
from tests.llm.conftest import ODD, odd_documents
from tidemark.llm import ngram_join as J
from tidemark.llm.words import words_of


def shingles(text):
    w = words_of(text)
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    at, root = {}, {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for k, (i, s) in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(k)
    for k, (i, s) in enumerate(sets):
        if i is None:
            continue
        for j in {j for x in s for j in at[x] if j < k}:
            o, t = sets[j]
            if o is not None and 100 * len(s & t) >= 75 * len(s | t):
                a, b = sorted((find(i), find(o)))
                root[b] = a
    return sorted(((i is not None, i or 0), len(s), None if i is None else find(i)) for i, s in sets)


def got(df):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in df.collect())


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert got(J.join_documents(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def families(seed, n=260):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(3000)]
    line = " ".join(rnd.choice(vocab) for _ in range(14))
    bases = [[rnd.choice(vocab) for _ in range(rnd.choice([3, 6, 8, 12, 20, 40, 90, 160]))] for _ in range(24)]
    rows = []
    for i in range(n):
        w = list(rnd.choice(bases[:3] if i % 3 == 0 else bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            k = rnd.randrange(len(w))
            w[k: k + 1] = rnd.choice([[], [rnd.choice(vocab)], [w[k], rnd.choice(vocab)]])
        text = " ".join(w)
        rows.append((i, f"{line}\n{text}" if i % 2 else text))
    return rows


@pytest.mark.parametrize("sizes", [(64, 32, 256, 12), (64, 32, 256, 0), (3, 3, 4, 0), (2, 64, 2, 1)])
def test_families_equal_brute_force(spark, monkeypatch, sizes):
    rows = families(11)
    random.Random(1).shuffle(rows)
    monkeypatch.setattr(J, "CHUNK", 3000)
    for name, value in zip(("BIG", "CROWD", "TILE", "MAX_PIVOT_ROUNDS"), sizes):
        monkeypatch.setattr(J, name, value)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(J.join_documents(df)) == brute(rows)


def test_similar_sets_share_a_signature():
    rnd = np.random.default_rng(4)
    bands = J._bands(75, 100, 5000)
    for _ in range(1500):
        n = int(rnd.integers(1, 400))
        a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        drop = int(rnd.integers(0, len(a) // 4 + 1))
        keep = np.sort(rnd.permutation(a)[drop:])
        add = rnd.integers(0, 1 << 63, int(rnd.integers(0, len(a) // 4 + 1)), dtype=np.uint64)
        b = np.unique(np.concatenate([keep, add]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            # unshared shingles of either side only count towards its size
            for extra in (0, 1, 3):
                na, nb = len(a) + extra, len(b) + extra // 2
                if 100 * both >= 75 * (na + nb - both):
                    assert len(np.intersect1d(J.signatures_of(a, na, bands, 75, 100), J.signatures_of(b, nb, bands, 75, 100)))


def test_edges(spark):
    for extra in (False, True):
        odd = odd_documents(spark, extra)
        assert got(J.join_documents(odd)) == brute([r[:2] for r in ODD])
        kept = J.keep_one(odd)
        assert kept.columns == odd.columns
        assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 3, 4, 5, 6, 7, 8, 10, 11]
    assert J.join_documents(odd_documents(spark).limit(0)).count() == 0


def test_copy_without_an_id_stands_first(spark):
    words = [f"w{i}" for i in range(60)]
    text, near, far = " ".join(words), " ".join(words[:-1] + ["other"]), " ".join(f"z{i}" for i in range(30))
    rows = [(None, text), (7, text), (8, near), (None, far), (None, far), (3, near + " more"), (9, far), (None, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert got(J.join_documents(df)) == brute(rows)
    assert {r["component_id"] for r in J.join_documents(df).filter("doc_id in (3, 7, 8)").collect()} == {3}


@pytest.mark.parametrize("dense", [1, 30, 1 << 30])
def test_counts_of_a_tile(monkeypatch, dense):
    monkeypatch.setattr(J, "DENSE", dense)
    rnd = np.random.default_rng(dense)
    left, right = ([np.unique(rnd.integers(0, 60, int(rnd.integers(0, 40))).astype(np.uint64) << np.uint64(16)) for _ in range(n)]
                   for n in (23, 17))
    got = J._common_counts(left, right)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert all((J._set(J._flat(x)) == x).all() for x in left)
    assert J._common_counts([], right).shape == (0, 17)
