import random

import numpy as np
import pytest

from tests.conftest import SF_MID
from tidemark.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=E.COSINE):
    def unit(v):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float64)
        return x / np.linalg.norm(x)

    u = [unit(v) for _, v, _ in rows]
    root, n = {i: i for i, _, _ in rows if i is not None}, [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p in range(len(rows)):
        for q in range(p):
            (i, _, a), (j, _, b) = rows[p], rows[q]
            if None in (i, j, a, b) or a != b or u[p] is None or u[q] is None or len(u[p]) != len(u[q]):
                continue
            if u[p] @ u[q] >= cosine:
                n[p] += 1
                n[q] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i is not None, i or 0, n[k], None if i is None else find(i)) for k, (i, _, _) in enumerate(rows))


def got(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in rows)
    return sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in rows)


def clouds(seed, n=500, dim=24):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((12, dim))
    out = []
    for i in range(n):
        v = centre[rng.integers(12)] + rng.standard_normal(dim) * rng.choice([0.0, 0.05, 0.15, 0.25, 0.3, 1.0])
        out.append((i, (v * rng.uniform(0.1, 9)).astype(np.float32).tolist(), int(rng.integers(3))))
    return out


@pytest.mark.parametrize("tile", [2048, 16])
def test_clouds_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(E, "TILE", tile)
    rows = clouds(3)
    assert got(E.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_table_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert got(E.near_duplicates(df)) == brute(rows)


def test_edges(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [float("inf"), 0.0], 1),
            (None, [1.0, 0.0], 1), (12, [1.0, 0.1], 1), (13, [-1.0, 0.0], 1), (14, [5.0], 1), (15, [-5.0], 1), (16, [7.0], 1),
            (20, [0.0, 1.0], 1), (20, [0.0, 1.0], 1), (17, [3e38, 3e38], 1), (18, [1e-38, 1e-38], 1)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("id", "mark", "unit", "cell", "n", "component"):
        df = df.selectExpr("*", f"'x' as `{c}`")
    assert got(E.near_duplicates(df)) == brute(rows)
    assert E.near_duplicates(df.limit(0)).count() == 0


def planted(seed, n=600, dim=64):
    """Vectors without structure, and near copies on both sides of the threshold."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    for i in range(0, n, 3):
        base[i] = base[(i + 2) % n] + rng.standard_normal(dim) * rng.choice([0.2, 0.35, 0.4, 0.5])
    return [(i, v.astype(np.float32).tolist(), int(i % 2)) for i, v in enumerate(base)]


@pytest.mark.parametrize("tile", [2048, 50])
def test_planted_near_copies_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(E, "TILE", tile)
    monkeypatch.setattr(E, "PAIRS", 64)
    rows = planted(5)
    want = brute(rows)
    assert sum(r[2] > 0 for r in want) > 60
    assert got(E.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == want


def test_blocks_leave_few_candidates(spark):
    """On the table, the union of the blocks' pairs is well under a tenth of all pairs of equal labels."""
    pdf = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    found = pairs = 0
    for _, g in pdf.groupby("label"):
        x = np.stack(g["embedding"].to_numpy()).astype(float)
        y = x / np.linalg.norm(x, axis=1, keepdims=True) @ E.rotation(x.shape[1])
        near = E.candidates(y, y, E._budgets(x.shape[1], E.COSINE))
        found += int(np.triu(near, 1).sum())
        pairs += len(x) * (len(x) - 1) // 2
    assert pairs > 150_000 and found < 0.1 * pairs


def test_dense_tile_in_bounded_memory():
    """4096 near-equal vectors: every pair is a link; counts and labels only, batches of PAIRS."""
    import tracemalloc
    rng = np.random.default_rng(1)
    x = 1 + 0.01 * rng.standard_normal((4096, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    every = np.arange(4096)
    tracemalloc.start()
    n = sum(len(u) for u, _ in E.links_between(x, x @ E.rotation(64), E._budgets(64, E.COSINE), every, every, E.COSINE))
    assert n == 4096 * 4095 // 2 and tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
