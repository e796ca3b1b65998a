import collections
import random
import re

import duckdb
import numpy as np
import pytest

from tests.conftest import SF_MID
from tests.llm.conftest import ODD, odd_documents
from tidemark.llm import phrases
from tidemark.llm.catalog import op12_phrase_collocations

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, minimum, longest=5, top=2000):
    """rows (lang, text): the contract, phrase by phrase."""
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {k: a for k, a in f.items() if a >= minimum and len(k[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, g), a in cand.items():
        inside = any(la == lang and len(h) > len(g) and b >= a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))
                     for (la, h), b in cand.items())
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, own in out.items() for i, (s, a, p, l, r) in enumerate(sorted(own)[:top]))


def made(seed, rows=400):
    rng = random.Random(seed)
    fixed = ["new york city", "once upon a time there", "a b a b a", "to be", "É é Z"]
    out = []
    for _ in range(rows):
        words = [rng.choice(["to", "be", "a", "b", "City", "é", "x", "time"]) for _ in range(rng.randint(0, 9))]
        out.append((rng.choice(["en", "en", "de", None]), rng.choice(["", ". ", ", ", "\t", "\r\n", "! "]).join(
            [" ".join(words), rng.choice(fixed), " ".join(rng.choice(fixed) for _ in range(2))])))
    return out


def rows_of(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


@pytest.mark.parametrize("seed,chunk", [(1, 1 << 20), (2, 50)])
def test_collocations_equal_brute_force(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    data = made(seed)
    df = spark.createDataFrame(data, "lang string, text string")
    got = rows_of(phrases.collocations(df, minimum=12))
    assert got == brute(data, 12) and len(got) > 30
    assert rows_of(phrases.collocations(df, minimum=12, top=3)) == brute(data, 12, top=3)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    data = made(3, 150)
    df = spark.createDataFrame(data, "lang string, text string")
    monkeypatch.setattr(phrases, "fingerprint_bits", lambda chars: 3)
    assert rows_of(phrases.collocations(df, minimum=8)) == brute(data, 8)
    chunk = phrases._Chunk([b"a", b"b"], np.array([0, 1, 0, 0]), np.array([4]), np.array([0]), [b"en"])
    at, _, counts = phrases._alike(chunk, np.arange(4), np.zeros(4, np.uint64), 1)  # one fingerprint for all
    assert sorted(zip(chunk.numbers[at].tolist(), counts.tolist())) == [(0, 3), (1, 1)]


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    got = spark.createDataFrame([(big, 4 * big, big, big + 1)], "a long, n long, l long, r long").selectExpr(
        "(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(38,0)) * r) as s").first()["s"]
    assert got == 1000 * big * 4 * big // (big * (big + 1))


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, extra):
    got = rows_of(phrases.collocations(odd_documents(spark, extra), minimum=2))
    assert got == brute([(r[2], r[1]) for r in ODD], 2)
    assert phrases.collocations(odd_documents(spark).limit(0)).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF_MID}/documents.parquet'")
    want = con.sql(f"select {', '.join(NAMES)} from ({phrases.SQL})").fetchall()
    got = rows_of(op12_phrase_collocations(spark, SF_MID))
    assert got == sorted(want) and len(got) > 20
