"""Registered queries against their SQL, and their columns."""

import pytest

from tablescope.llm.queries import QUERIES, ORACLE_SQL
from tools.compare_oracle import compare
from tests.llm.conftest import SF

COLUMNS = {
    "op1_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op2_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op3_minhash_dedup": "doc_id n_shingles component_id kept",
    "op4_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op5_exact_top_k": "query_id rank vec_id score",
    "op6_token_store": "doc_id start n_tokens ids_crc32",
    "op7_url_filter": "page_id host path rule verdict",
    "op8_chat_format": "conv_id segment n_lines n_turns states rendered",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_pii_crf": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_lexical_search": "item_id rank doc_id score",
    "op13_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_columns_and_rows(spark, key):
    found = QUERIES[key](spark, SF)
    assert found.columns == COLUMNS[key].split()
    assert found.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_sql(spark, key):
    assert compare(spark, SF, [key])[key]["status"] == "match"
