"""The pipeline against its operators' brute-force versions, stage by stage."""

import corpus_pipeline as P
from tests.conftest import SF_MID
from tests.llm.conftest import odd_documents
from tests.llm.test_bpe import expected, library
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_ngram_join import brute as groups
from tidemark.llm.langid import has_letter


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    rows = [r for r in rows if has_letter(r[1])]
    ids = {i[1]: c for i, _, c in groups(rows)}
    rows = [r for r in rows if ids[r[0]] == r[0]]
    short = {i for i, t in rows if len(t) < 4000}
    bad = {i for i, _ in leaks([r for r in rows if r[0] in short], items)}
    got = {r["doc_id"]: r for r in P.run(spark, SF_MID).collect()}
    assert {i for i in got if i in short} == short - bad
    code, texts = library(), dict(rows)
    from tidemark.llm import secrets
    hidden = {r["doc_id"] for r in secrets.scan(docs).filter("spans != ''").select("doc_id").collect()}
    for i, r in got.items():
        if i in hidden:
            assert r["n_tokens"] != 0
        else:
            assert tuple(r)[1:] == expected(code, texts[i])


def test_stages_keep_columns_and_odd_rows(spark):
    odd = odd_documents(spark, extra=True).withColumn("n_chars", P.secrets.F.length("text").cast("long"))
    for docs in (odd, odd.limit(0)):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF_MID)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()
    assert {r["doc_id"] for r in P.language(spark, odd, SF_MID).collect()} == {4, 5, 7, 8, 9, 10, 11}


def test_copies_and_leaks_go_whatever_their_ids(spark):
    def text(name, *more):
        return " ".join([f"{name}{i}" for i in range(60)] + list(more))

    rows = [(1, text("a")), (1, text("a")), (1, text("b")), (2, text("a", "near")), (None, text("a", "copy")),
            (None, text("a")), (3, text("b")), (None, text("c")), (None, text("c")), (4, text("d")),
            (5, text("e")), (5, text("e", "near")), (6, text("f")), (6, text("f").upper()), (1, ""), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "'x' as _text")
    out = P.near_duplicates(spark, docs, SF_MID)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], (r["text"].lower().split() or [""])[0]) for r in out.collect()]
    assert sorted(kept, key=str) == sorted([(1, "a0"), (1, "b0"), (None, "c0"), (4, "d0"), (5, "e0"), (6, "f0"), (1, ""), (1, "")], key=str)

    items = spark.createDataFrame([(70, text("q")), (71, text("r"))], "item_id long, text string")
    rows = [(1, text("x")), (1, text("y", text("q"))), (None, text("z", text("r"))), (None, text("v")), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = P.decontaminate.clean(docs, items)
    assert sorted(map(tuple, left.collect()), key=str) == sorted([rows[0], rows[3], rows[4]], key=str)
