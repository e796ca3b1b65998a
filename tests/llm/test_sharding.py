import itertools
import zlib
from collections import Counter

import numpy as np

from tests.conftest import SF_MID
from tests.llm.conftest import ODD, odd_documents
from tidemark.llm import sharding


def test_curve_is_a_walk_through_all_points():
    for d, bits in ((2, 3), (3, 2), (4, 2)):
        pts = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        ix = sharding.hilbert_index(pts, bits)
        assert sorted(ix) == list(range(len(pts)))
        walk = pts[np.argsort(ix)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def whole(rows, n, shards=16):
    assert len(rows) == n
    count = Counter(r["shard"] for r in rows)
    assert max(count.values()) - min(count.get(s, 0) for s in range(shards)) <= 1
    for s in count:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(count[s]))
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in rows)


def test_shards(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = sharding.shard_table(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    whole(rows, len(texts))
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]].encode()) + 1, zlib.crc32(texts[r["doc_id"]].encode())) for r in rows)
    span = sharding.ranges(sharding.order_and_cut(docs)).collect()
    assert len(span) == 16 and all(r["min_d2"] <= r["max_d2"] for r in span)


def test_edges(spark):
    for extra in (False, True):
        whole(sharding.shard_table(odd_documents(spark, extra)).collect(), len(ODD))
    assert sharding.shard_table(odd_documents(spark).limit(0)).count() == 0
    same = spark.createDataFrame([(1, "t", "en", "s")] * 500, "doc_id long, text string, lang string, source string")
    whole(sharding.shard_table(same).collect(), 500)
