"""Each operator's query on the whole smallest tables: its columns, and one row per input row where promised."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

COLUMNS = {
    "op1_tool_call_links": ("conversations", "conv_id call_id name call_turn result_turn status level errors record"),
    "op2_secret_scan": ("documents", "doc_id n_assign n_access n_hex base_sha256 spans"),
    "op3_hilbert_shards": ("documents", "doc_id size text_crc32 law shard slot grown_shard"),
    "op4_byte_bpe": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op5_ngram_jaccard_join": ("documents", "doc_id n_shingles component_id"),
    "op6_language_id": ("documents", "doc_id held_out lang_pred score"),
    "op7_lattice_scores": ("documents", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    "op8_embedding_near_dedup": ("embeddings", "vec_id n_links component_id kept"),
    "op9_benchmark_decontamination": ("documents", "doc_id item_id similarity"),
    "op10_html_main_text": ("pages", "page_id url text n_chars"),
    "op11_periodic_runs": ("documents", "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256"),
    "op12_phrase_collocations": ("documents", "lang rank phrase a l r n score"),
    "op13_toxicity": ("documents", "doc_id held_out score predicted"),
    "pipeline": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
}
SHORTER = {"op1_tool_call_links", "op12_phrase_collocations", "op9_benchmark_decontamination", "pipeline"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    table, columns = COLUMNS[name]
    df = E.queries()[name](spark, SF_SMALL)
    assert set(columns.split()) <= set(df.columns)
    n, rows = df.count(), spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    assert 0 < n < rows if name in SHORTER else n == rows
