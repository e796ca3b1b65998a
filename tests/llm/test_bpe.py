import hashlib

import numpy as np
import tiktoken

from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD, odd_documents
from tidemark.llm import bpe


def library():
    ranks, pattern = bpe.vocabulary()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def expected(code, text):
    ids = code.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_odd_texts_equal_the_library(spark):
    code = library()
    for extra in (False, True):
        got = sorted(((r[0] is not None, r[0] or 0), tuple(r)[1:]) for r in bpe.digests(odd_documents(spark, extra)).collect())
        want = sorted(((i is not None, i or 0), expected(code, t)) for i, t, _, _ in ODD)
        assert got == want
    assert bpe.digests(odd_documents(spark).limit(0)).count() == 0


def test_table_equals_the_library_and_decodes(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    code = library()
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got == {i: expected(code, t) for i, t in texts.items()}
    back = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(bpe.encode(docs)).collect()}
    assert back == texts
