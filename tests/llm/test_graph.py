import random

import pytest

from tidemark.llm import graph


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    return sorted((x, find(x)) for x in root)


@pytest.mark.parametrize("local", [1 << 20, 0])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL", local)
    rng = random.Random(2)
    ids = [rng.randint(-(2**63), 2**63 - 1) for _ in range(120)]
    chain = [(ids[i], ids[i + 1]) for i in range(60)]
    rng.shuffle(chain)
    edges = chain + [(rng.choice(ids[60:]), rng.choice(ids[60:])) for _ in range(35)] + chain[:5] + [(ids[0], ids[0])]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert sorted(map(tuple, graph.components(df, "a", "b").collect())) == brute(edges)
    assert graph.components(df.limit(0), "a", "b").count() == 0
