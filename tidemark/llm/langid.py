"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams (1 to ``ORDER`` characters of the lower-cased text, runs of non-letters
read as one space) into ``BUCKETS`` hashed buckets per language inside each task and sums the
sparse counts with an ordinary aggregation. The log-probability matrix, BUCKETS x languages
doubles, is all that reaches the driver and is broadcast; ``MAX_LANGS`` bounds it. Prediction
reads the matrix rows of a text's n-grams and sums them, in slices so that a very long text
needs bounded memory.

A text that is null or has no letter gets ``und`` with score 0, as does every text when nothing
could be learned. Texts with equal sums go to the alphabetically first language.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.rows import small_batches

BUCKETS = 1 << 15
ORDER = 3
MAX_LANGS = 512
ALPHA = 0.5  # added to each bucket's count
SLICE = 1 << 18
UND = "und"
_OTHER = re.compile(r"[\W\d_]+")
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_buckets(text: str):
    """Bucket numbers of all n-grams of a text, slice by slice."""
    cp = np.frombuffer((" " + _OTHER.sub(" ", text.lower()).strip() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(cp), SLICE):
        part = cp[at: at + SLICE + ORDER - 1].astype(np.uint64)
        own, out = min(SLICE, len(cp) - at), []
        h = np.zeros(len(part), np.uint64)
        for n in range(ORDER):
            h = h[: len(part) - n] * _MULT[2] + (part[n:] + np.uint64(1)) * _MULT[n % 2]
            got = h[:own] ^ (h[:own] >> np.uint64(29))
            out.append(((got * _MULT[0]) >> np.uint64(64 - 15)).astype(np.int64) & (BUCKETS - 1))
        yield np.concatenate(out)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """True where crc32(doc_id as text) mod folds is fold; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds) == fold


def _count(batches):
    kept: dict[str, list] = {}
    sums: dict[str, np.ndarray] = {}
    held = 0

    def fold():
        for lang, parts in kept.items():
            add = np.bincount(np.concatenate(parts), minlength=BUCKETS)
            sums[lang] = sums[lang] + add if lang in sums else add
        kept.clear()

    docs: dict[str, int] = {}
    for pdf in batches:
        for text, lang in zip(pdf["text"], pdf["lang"]):
            if not has_letter(text):
                continue
            docs[lang] = docs.get(lang, 0) + 1
            for b in gram_buckets(text):
                kept.setdefault(lang, []).append(b)
                held += len(b)
            if held > 1 << 22:
                fold()
                held = 0
    fold()
    for lang, counts in sums.items():
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": np.append(at, -1), "n": np.append(counts[at], docs[lang])})


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix of log-probabilities; its last row holds the log-priors.

    docs: labelled rows (text, lang); rows without a label or a letter teach nothing.
    """
    counts = (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
              .mapInPandas(_count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    priors = counts.filter("bucket = -1").orderBy("lang").limit(MAX_LANGS + 1).collect()
    if len(priors) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: the model would not be a small broadcast")
    langs = [r["lang"] for r in priors]
    table = np.zeros((BUCKETS, len(langs)))
    rows = counts.filter("bucket >= 0").toPandas() if langs else pd.DataFrame({"lang": [], "bucket": [], "n": []})
    at = {x: i for i, x in enumerate(langs)}
    table[rows["bucket"].to_numpy(int), rows["lang"].map(at).to_numpy(int)] = rows["n"].to_numpy(float)
    logs = np.log(table + ALPHA) - np.log(table.sum(0) + ALPHA * BUCKETS)
    n = np.array([r["n"] for r in priors], float)
    return langs, np.vstack([logs, np.log(n / n.sum()) if langs else n])


def predictor(spark: SparkSession, model: tuple[list[str], np.ndarray]):
    """A function from a text column to struct(lang_pred, score); score: posterior of the best language."""
    langs, table = model
    sent = spark.sparkContext.broadcast(table)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        logs, best, share = sent.value, [], []
        for text in texts:
            if not langs or not has_letter(text):
                best.append(UND)
                share.append(0.0)
                continue
            total = logs[BUCKETS].copy()
            for b in gram_buckets(text):
                total += logs[b].sum(0)
            i = int(total.argmax())
            best.append(langs[i])
            share.append(float(1 / np.exp(total - total[i]).sum()))
        return pd.DataFrame({"lang_pred": best, "score": share})

    return predict


def _learned(docs: DataFrame):
    small_batches(docs.sparkSession)
    return predictor(docs.sparkSession, train(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang")))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of docs(doc_id, text, lang)."""
    got = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _learned(docs)(F.col("text")).alias("p"))
    return got.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_known(docs: DataFrame) -> DataFrame:
    """docs without the documents that get no language (no letter, or nothing was learned); the
    decision is taken where the row is, without a join, and every column stays as it was."""
    return docs.filter(_learned(docs)(F.col("text"))["lang_pred"] != UND)
