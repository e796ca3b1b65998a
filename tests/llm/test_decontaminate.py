import random

import numpy as np

from tests.conftest import SF_MID
from tests.llm.conftest import odd_documents
from tidemark.llm import decontaminate as D
from tidemark.llm.words import words_of


def brute(docs, items, threshold=D.THRESHOLD):
    """Every window of an item's length against every item."""
    t = D.Items(items)
    out = set()
    for i, text in docs:
        words = words_of(text)
        for k, n in enumerate(t.lengths):
            size = min(5, int(n))
            h = D.window_hashes(words, size) if len(words) >= size else np.empty(0, np.uint64)
            for at in range(max(1, len(words) - int(n) + 1) if len(h) else 0):
                own = h[at: at + max(int(n) - size, 0) + 1]
                if set(own.tolist()) & set(t.counts[k]) and t.similarity(k, own) >= threshold:
                    out.add((i, t.ids[k]))
    return out


def test_finds_planted_passages_and_edits(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(15, 60)))) for i in range(30)]
    items += [(98, "tiny item"), (99, None), (100, ""), (101, items[0][1])]
    docs = []
    for d in range(120):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 200))]
        if d % 3 == 0:
            part = rnd.choice(items[:30])[1].upper().split()
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                part[rnd.randrange(len(part))] = "changed"
            words[len(words) // 2: len(words) // 2] = part
        docs.append((d, "  ".join(words)))
    docs += [(500, "a tiny item here"), (501, None), (502, ""), (503, docs[0][1]), (503, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.matches(df, bench).collect()
    got, want = {(r["doc_id"], r["item_id"]) for r in rows}, brute(docs, items)
    assert got <= want and len(want - got) <= 0.02 * len(want)
    assert all(r["similarity"] >= 0.75 for r in rows)
    assert D.clean(df, bench).count() == sum(1 for d in docs if d[0] not in {i for i, _ in got})


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    bench = spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    whole = sorted(map(tuple, D.matches(docs, bench).collect()))
    pairs = {r[:2] for r in whole}
    assert pairs == brute([(r["doc_id"], r["text"]) for r in docs.filter("length(text) < 3000").collect()],
                          [(r["item_id"], r["text"]) for r in bench.collect()]) | {
        p for p in pairs if p[0] in {r["doc_id"] for r in docs.filter("length(text) >= 3000").collect()}}
    monkeypatch.setattr(D, "BLOCK", 9)
    assert {r[:2] for r in map(tuple, D.matches(docs, bench).collect())} == pairs


def test_index_finds_all_within_the_radius():
    rnd = np.random.default_rng(2)
    t = D.Items([(i, " ".join(map(str, rnd.integers(0, 50, 20)))) for i in range(50)])
    for _ in range(300):
        p = int(t.prints[rnd.integers(50)])
        for b in rnd.choice(64, rnd.integers(0, 26), replace=False):
            p ^= 1 << int(b)
        assert t.within(p) == [k for k in range(50) if bin(int(t.prints[k]) ^ p).count("1") <= D.RADIUS]


def test_edges(spark):
    bench = spark.createDataFrame([(1, "x")], "item_id long, text string")
    for extra in (False, True):
        odd = odd_documents(spark, extra)
        assert D.matches(odd, bench.limit(0)).count() == 0
        assert D.matches(odd.limit(0), bench).count() == 0
        assert {r["doc_id"] for r in D.matches(odd, spark.createDataFrame([(7, "same text here now ok")], "item_id long, text string")).collect()} == {8, 9}
        assert D.clean(odd, bench).columns == odd.columns and D.clean(odd, bench).count() == odd.count()


def test_weights_are_of_the_whole_benchmark(spark, monkeypatch):
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    lines = [[rnd.choice(vocab) for _ in range(12)] for _ in range(4)]
    items = [(i, " ".join(lines[i % 4] + [rnd.choice(vocab) for _ in range(rnd.randint(10, 30))] + lines[i % 3])) for i in range(24)]
    docs = []
    for d in range(60):
        part = items[d % 24][1].split()
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            part[rnd.randrange(len(part))] = "changed"
        docs.append((d, " ".join([rnd.choice(vocab) for _ in range(20)] + part + rnd.choice(lines))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, D.matches(df, bench).collect()))
    assert len(whole) > 20 and {r[:2] for r in whole} <= brute(docs, items)
    monkeypatch.setattr(D, "BLOCK", 5)
    assert sorted(map(tuple, D.matches(df, bench).collect())) == whole
    kept = {r["doc_id"] for r in D.clean(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {r[0] for r in whole}
