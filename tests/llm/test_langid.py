import zlib

from tests.conftest import SF_MID
from tests.llm.conftest import ODD, odd_documents
from tidemark.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(300)
    other = docs.withColumn("lang", langid.F.when(langid.held_out(docs["doc_id"]), "zz").otherwise(docs["lang"]))
    assert sorted(map(tuple, langid.identify(docs).collect())) == sorted(map(tuple, langid.identify(other).collect()))


def test_edges(spark):
    for extra in (False, True):
        got = {r["doc_id"]: r for r in langid.identify(odd_documents(spark, extra)).collect()}
        assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {None, 1, 2, 3, 6}
        assert all(got[i]["score"] == 0.0 for i in (1, 2, 3, 6))
    assert langid.identify(odd_documents(spark)).count() == len(ODD)
    assert langid.identify(odd_documents(spark).limit(0)).count() == 0
    unlabelled = odd_documents(spark).withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}


def test_slices_equal_the_whole(monkeypatch):
    import numpy as np
    text = "Ein längerer Text, dont le sens importe peu. " * 50
    whole = np.sort(np.concatenate(list(langid.gram_buckets(text))))
    monkeypatch.setattr(langid, "SLICE", 97)
    assert (np.sort(np.concatenate(list(langid.gram_buckets(text)))) == whole).all()


def test_predictions_equal_brute_force(spark):
    """Naive Bayes by counting: every n-gram of every text, one at a time."""
    import math
    from collections import Counter, defaultdict

    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").limit(240).collect()] + [
        (r[0] and r[0] + 1_000_000, *r[1:3]) for r in ODD]
    counts, docs = defaultdict(Counter), Counter()

    def grams(text):
        return [int(b) for part in langid.gram_buckets(text) for b in part]

    for i, text, lang in rows:
        if lang is not None and langid.has_letter(text) and zlib.crc32(("" if i is None else str(i)).encode()) % 3 != 1:
            docs[lang] += 1
            counts[lang].update(grams(text))
    want = {}
    for i, text, _ in rows:
        if not langid.has_letter(text):
            want[i] = ("und", 0.0)
            continue
        logs = {}
        for lang, c in counts.items():
            total = sum(c.values()) + langid.ALPHA * langid.BUCKETS
            logs[lang] = math.log(docs[lang] / sum(docs.values())) + sum(math.log((c[g] + langid.ALPHA) / total) for g in grams(text))
        best = max(sorted(logs), key=logs.get)
        want[i] = (best, 1 / sum(math.exp(x - logs[best]) for x in logs.values()))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    for r in langid.identify(df).collect():
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9
