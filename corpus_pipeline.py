"""The corpus pipeline: language, near-duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result as Parquet into the folder of ``spark.checkpoint.dir`` and reads it back as the next
one's documents, so a lost executor repeats one stage at most. All stages but the last return
the columns of ``documents``:

1. language: documents without a letter (``und``) go, all others stay as they are;
2. near duplicates: of each group of rows linked by shingle similarity one row stays, that with
   the smallest doc_id; copies under the same id or without an id go too;
3. benchmark: documents that hold a benchmark item go, whatever their ids;
4. secrets: spans are masked in the text, n_chars follows;
5. tokens: token counts and digests per document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, langid, ngram_join, secrets
from tidemark.session import ensure_checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(docs, items)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("secrets", mask_secrets), ("tokens", tokens)]

# Byte-pair merges and the learned language model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    place = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return docs
