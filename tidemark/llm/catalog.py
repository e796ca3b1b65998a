"""One query per operator, over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import (bpe, decontaminate, embedding_dedup, html_text, langid, lattice, ngram_join, phrases, runs, secrets,
                          sharding, tool_calls, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


@_query
def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(_table(spark, sf_dir, "documents"))


@_query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"))


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


@_query
def op7_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(_table(spark, sf_dir, "documents"))


@_query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(_table(spark, sf_dir, "documents"))


@_query
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@_query
def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


@_query
def op1_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link(tool_calls.events(_table(spark, sf_dir, "conversations")))


def periodic_rewrite(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Makes a tenth of the documents periodic from some word on, as their id's checksum says."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a: a + p] * -(-(n - a) // p))[: n - a]


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(_table(spark, sf_dir, "documents"), periodic_rewrite))


@_query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


SQL["op12_phrase_collocations"] = phrases.SQL


@_query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
