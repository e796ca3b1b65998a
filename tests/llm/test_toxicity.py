import zlib

import numpy as np
import pandas as pd
import pytest

from tests.conftest import SF_MID
from tests.llm.conftest import ODD, odd_documents
from tidemark.llm import toxicity
from tidemark.llm.catalog import op13_toxicity

LABELS = "doc_id long, quality int, toxic int"


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    numbers, texts, y, langs = toxicity._Numbers(), [], [], []
    for i in range(800):
        lang = "ab"[i % 2]
        words = [f"{lang}{rng.choice(list('klmnop'))}{rng.choice(list('qrst'))}" for _ in range(rng.integers(5, 60))]
        y.append(int(i % 5 == 0))
        if y[-1]:
            words[rng.integers(len(words))] = lang + "vile" + rng.choice(list("xyz"))
        texts.append(numbers.of(words))
        langs.append(lang)
    return toxicity.fit(texts, np.array(y), langs), numbers


def brute(model, numbers):
    """Every filter at every place, one by one."""
    best = []
    x = model.embed(numbers)
    for w, b in zip(model.filters, model.bias):
        for f in range(toxicity.FILTERS):
            own = [0.0]
            for i in range(len(x)):
                own.append(b[f] + sum(float(x[i + t] @ w[t][:, f]) for t in range(len(w)) if i + t < len(x)))
            best.append(max(own))
    logit = float(np.array(best) @ model.top + model.top_bias)
    lang = int(model.lang_logs[numbers // toxicity.BUCKETS].astype(float).sum(0).argmax()) if model.langs else -1
    return 1 / (1 + np.exp(-(logit - model.thresholds[lang])))


def test_scores_equal_plain_convolution(model, monkeypatch):
    m, numbers = model
    texts = [numbers.of(x.split()) for x in ("", "akq", "bkr blq", "amq anr avilex aos akq", "bkr " * 50, "zz yy xx")]
    want = [brute(m, x) for x in texts]
    for size in (1 << 17, 7, 2):
        monkeypatch.setattr(toxicity, "SLICE", size)
        assert toxicity.score_texts(m, texts) == pytest.approx(want, rel=1e-3, abs=1e-6)


def test_learns_words_and_stems_with_thresholds_by_language(model):
    m, numbers = model
    assert m.langs == ["a", "b"] and len(m.thresholds) == 3
    got = toxicity.score_texts(m, [numbers.of(x.split()) for x in (
        "akq amr aviley aos", "bkq bmr bvilez bos", "akq amr aos", "bkq bmr bos bpt", "akq avilew amr", "")])
    assert list(got >= 0.5) == [True, True, False, False, True, False]  # avilew: by its stem alone


def test_threshold():
    z, y = np.array([3.0, 2.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 1, 0])
    assert toxicity.best_threshold(z, y, np.ones(5)) == 0.5
    assert toxicity.best_threshold(z, y, np.where(y == 1, 1.0, 9.0)) == 2.5


def test_held_out_accuracy_on_table(spark):
    got = op13_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    got = got.merge(labels, on="doc_id")
    assert list(got["held_out"]) == [held(i) for i in got["doc_id"]]
    test = got[got["held_out"]]
    hit = test["toxic"] == 1
    assert hit.sum() > 50
    assert (test["predicted"] == (test["score"] >= 0.5)).all()
    assert test.loc[hit, "predicted"].mean() >= 0.9 and test.loc[~hit, "predicted"].mean() <= 0.02


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "quality", "toxic")
    flipped = labels.toPandas()
    flipped.loc[[held(i) for i in flipped["doc_id"]], "toxic"] ^= 1
    a = toxicity.score(docs, labels).orderBy("doc_id").toPandas()
    b = toxicity.score(docs, spark.createDataFrame(flipped)).orderBy("doc_id").toPandas()
    pd.testing.assert_frame_equal(a, b)
    assert len(a) == docs.count() and a["score"].between(0, 1).all()


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, extra):
    docs = odd_documents(spark, extra)
    some = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (7, 0, 1), (8, 0, 0), (11, None, None), (None, 0, 1), (9, 0, 0), (9, 0, 1)], LABELS)
    one = spark.createDataFrame([(4, 1, 1)], LABELS)
    for labels in (some, one, one.limit(0)):
        got = toxicity.score(docs, labels).collect()
        assert sorted((r["doc_id"] or -1, r["held_out"]) for r in got) == sorted((r[0] or -1, held(r[0])) for r in ODD)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
        assert toxicity.score(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in toxicity.score(docs, one).collect()} == {0.0 if held(4) else 1.0}
    assert {r["score"] for r in toxicity.score(docs, one.limit(0)).collect()} == {0.0}


def test_big_ids_beside_null(spark):
    big = 2**53 + 1
    docs = spark.createDataFrame([(big, "a", "en"), (None, "b", "en"), (big + 2, None, None)], "doc_id long, text string, lang string")
    got = toxicity.score(docs.coalesce(1), spark.createDataFrame([(big, 0, 1)], LABELS)).collect()
    assert {r["doc_id"] for r in got} == {big, None, big + 2}


def test_every_labelled_row_teaches(spark, monkeypatch):
    """A word that only rows beyond any bound hold, in texts of any length, reaches the counts."""
    ids = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5 != 0]
    docs = spark.createDataFrame([(i, f"word{i} " + "filler " * (9000 if i == ids[-1] else 2), "en") for i in ids], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 0, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    rows = toxicity.learned(docs, labels).toPandas()
    assert len(rows) == len(ids) and max(map(len, rows["numbers"])) == 4 * 9001
    assert sorted(rows.loc[rows["toxic"] == 1, "place"]) == list(range(int((rows["toxic"] == 1).sum())))
    counts, words = toxicity._counts(toxicity.learned(docs, labels), ["en"])
    filler = toxicity._Numbers()["filler"] // toxicity.BUCKETS
    assert counts[:, 0, 0, filler].sum() == (rows["place"] % toxicity.CALIBRATE != toxicity.CALIBRATE - 1).sum()
    assert words[0, filler] >= 9000 + 2 * (len(ids) - 1)
    assert toxicity.train(docs, labels).constant is None
    monkeypatch.setattr(toxicity, "SENT_IDS", 0)
    order = ["toxic", "place"]
    pd.testing.assert_frame_equal(toxicity.learned(docs, labels).toPandas().sort_values(order, ignore_index=True), rows.sort_values(order, ignore_index=True))
