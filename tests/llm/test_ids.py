"""Identifiers above 2**53 beside a null in one batch come back as they were, from every operator."""

import pytest

from tidemark.llm import (bpe, decontaminate, embedding_dedup, html_text, langid, lattice, ngram_join, runs, secrets,
                          sharding, tool_calls, toxicity)

A, B = 2**53 + 1, 2**53 + 3
TEXT = "one two three four five six seven eight nine ten eleven twelve"


def docs(spark):
    rows = [(A, TEXT, "en", "s"), (None, None, None, None), (B, TEXT + " thirteen", "en", "s"), (-A, "x", "de", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)


def labels(spark):
    return spark.createDataFrame([(A, 1), (B, 0)], "doc_id long, toxic int")


def bench(spark):
    return spark.createDataFrame([(A, TEXT), (None, "another item that is nowhere to be found at all")], "item_id long, text string").coalesce(1)


OPERATORS = {
    "secrets": lambda s: secrets.scan(docs(s)), "sharding": lambda s: sharding.shard_table(docs(s)),
    "bpe": lambda s: bpe.digests(docs(s)), "decode": lambda s: bpe.decode(bpe.encode(docs(s))),
    "ngram_join": lambda s: ngram_join.join_documents(docs(s)), "langid": lambda s: langid.identify(docs(s)),
    "lattice": lambda s: lattice.score(docs(s)), "runs": lambda s: runs.periodic_runs(docs(s)),
    "toxicity": lambda s: toxicity.score(docs(s), labels(s)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_document_ids(spark, name):
    got = [r["doc_id"] for r in OPERATORS[name](spark).collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == sorted([A, B, -A, None], key=lambda x: (x is None, x))


def test_components_and_kept_rows(spark):
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join_documents(docs(spark)).collect()}
    assert got == {A: A, B: A, -A: -A, None: None}
    assert {r["doc_id"] for r in ngram_join.keep_one(docs(spark)).collect()} == {A, -A, None}


def test_benchmark_ids(spark):
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs(spark), bench(spark)).collect()}
    assert got == {(A, A), (B, A)}


def test_vector_ids_and_labels(spark):
    rows = [(A, [1.0, 0.0], B), (None, [1.0, 0.0], None), (B, [1.0, 0.01], B), (B + 2, [1.0, 0.0], B + 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").coalesce(1)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {A: (1, A), B: (1, A), B + 2: (0, B + 2), None: (0, None)}


def test_page_ids(spark):
    rows = [(A, "http://a/1", "<article><p>x</p></article>"), (None, None, None), (B, "http://a/2", "<p>y</p>")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()
    assert {r["page_id"]: r["text"] for r in got} == {A: "x", None: "", B: "y"}


def test_conversation_ids_and_turns(spark):
    rows = [(A, B, "user", "hi"), (None, None, "user", "lost"), (A, B + 1, "assistant", "hello"), (B, None, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    got = {(r["conv_id"], r["call_turn"], r["result_turn"], r["status"]) for r in tool_calls.link(tool_calls.events(df)).collect()}
    assert (A, B, B + 1, "linked") in got and (None, None, None, "unidentified") in got
