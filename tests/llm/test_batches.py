"""Rows on their way to Python: a batch of texts is bounded in bytes, not in rows alone."""

import pandas as pd

from pyspark.sql import functions as F

from tidemark.llm import chunks, decontaminate, langid, ngram_join
from tidemark.llm.rows import BATCH


def texts(spark, n=3000):
    return spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat_ws(" ", F.lit("word"), "id"), 600).alias("text"),
                                          F.lit("en").alias("lang"), F.lit(True).alias("flag"))


def batch_sizes(rows):
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [int(pdf["text"].str.len().sum())]})

    return [r["n"] for r in rows.mapInPandas(run, "n long").collect()]


def test_texts_reach_the_tokenizer_in_bounded_batches(spark):
    own = spark.newSession()
    docs = texts(own)
    sizes = batch_sizes(chunks._rows(docs))
    assert sum(sizes) == docs.agg(F.sum(F.length("text"))).first()[0] > 12 << 20
    assert max(sizes) < 5 << 20


def test_every_python_stage_bounds_its_batches(spark):
    items = "select 1L as item_id, 'a b c' as text"
    for stage in (langid.keep_known, ngram_join.shared_sets, lambda docs: decontaminate.clean(docs, docs.sparkSession.sql(items)),
                  chunks._rows):
        own = spark.newSession()
        stage(texts(own, 3))
        assert own.conf.get(BATCH) == "4m"
        own = spark.newSession()
        own.conf.set(BATCH, "1m")  # a size of the user's own stays
        stage(texts(own, 3))
        assert own.conf.get(BATCH) == "1m"
