"""Queries with SQL against DuckDB, and the rows all queries promise, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from spendlake.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_near_dedup": "doc_id n_shingles component_id kept",
    "op3_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op4_lm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_mixing": "doc_id size source_size target taken",
    "op7_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op8_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op9_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_quality_classifier": "doc_id held_out score predicted",
    "op11_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op12_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, small_folder):
    result = QUERIES[name](spark, small_folder)
    rows = result.collect()
    documents = spark.read.parquet(f"{small_folder}/documents.parquet")
    assert set(COLUMNS[name].split()) <= set(result.columns)
    if "doc_id" in result.columns:
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in documents.collect())
    if name in ORACLES:
        with duckdb.connect() as connection:
            for table in ("documents", "labels"):
                connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_folder}/{table}.parquet'")
            expected = connection.sql(ORACLES[name])
            names = list(expected.columns)
            assert sorted(names) == sorted(result.columns)
            assert Counter(expected.fetchall()) == Counter(tuple(r[n] for n in names) for r in rows)
