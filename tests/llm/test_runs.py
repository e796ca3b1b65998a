import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD, odd_documents
from tidemark.llm import runs
from tidemark.llm.catalog import op11_periodic_runs, periodic_rewrite
from tidemark.llm.runs import collapse, find_runs


def brute(words):
    """Every stretch with period q that cannot be extended, kept with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                key = (i, j - i + q)
                found[key] = min(q, found.get(key, q))
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(1, 7), st.integers(0, 8))
def test_runs_equal_brute_force(words, period, times):
    words = words + words[:period] * times + words[:3]
    assert find_runs(words) == brute(words)


def test_longer_sequences():
    rng = random.Random(3)
    for _ in range(60):
        words = []
        while len(words) < 400:
            block = [rng.choice([b"a", b"b", b"xy"]) for _ in range(rng.randint(1, 12))]
            words += block * rng.randint(1, 9) + [b"z"] * rng.randint(0, 2)
        assert find_runs(words) == brute(words)


def test_one_word_and_one_line_many_times():
    assert find_runs([b"w"] * 200_000) == [(0, 200_000, 1)]
    line = [b"the", b"same", b"line", b"again"]
    assert find_runs([b"x", *line * 30_000, b"the"]) == [(1, 120_001, 4)]
    assert collapse([b"w"] * 6, [(0, 6, 1)]) == [b"w"]


def test_periods_and_ends():
    assert find_runs([b"a"] * 5) == []
    assert find_runs([b"a", b"b"] * 3) == []
    assert find_runs([b"a", b"b"] * 4) == [(0, 8, 2)]
    assert find_runs([b"a", b"a", b"b"] * 4) == [(0, 12, 3)]


def digest(row_id, text):
    """The query's row, from the definition."""
    words = [] if text is None else text.encode().split()
    h = zlib.crc32(str(row_id).encode()) if row_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    got, drop = brute(words), set()
    for s, length, q in got:
        drop.update(range(s + q, s + length))
    best = sorted(got, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
    s, length, q = best[0] if best else (None, None, None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (row_id, len(got), s, length, q, best and 1000 * length // q or None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in got).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


def as_rows(df):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def test_query_on_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = sorted((digest(r["doc_id"], r["text"]) for r in docs), key=str)
    assert as_rows(op11_periodic_runs(spark, SF_SMALL)) == want
    assert sum(r[1] for r in want) > 20


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, extra):
    got = as_rows(runs.digests(runs.periodic_runs(odd_documents(spark, extra), periodic_rewrite)))
    assert got == sorted((digest(r[0], r[1]) for r in ODD), key=str)
    assert runs.periodic_runs(odd_documents(spark).limit(0)).count() == 0


def test_big_ids_beside_null(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, "a " * 9), (None, "b"), (big + 2, None)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in runs.periodic_runs(df).collect()}
    assert got == {big: [(0, 9, 1)], None: [], big + 2: []}
