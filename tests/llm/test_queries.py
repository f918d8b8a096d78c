"""The registered queries: their SQL where there is one, and the columns and types they promise."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as E  # noqa: E402
from tickforge.llm import queries as Q  # noqa: E402
from tools.oracle_check import TABLES, digest, duck_rows, spark_rows  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op2_warc_round_trip": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op3_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op4_minhash_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op5_embedding_near_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op6_token_counts": "n_tokens bigint, n_docs bigint, docs_over bigint, tokens_over bigint, docs_in_all bigint, tokens_in_all bigint, quantile double, tokens_cut bigint",
    "op7_bpe_round_trip": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op8_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op9_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op11_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op12_byte_bpe_round_trip": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op13_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(Q.ORACLE))
def test_query_matches_sql(spark, duck, key):
    got = Q.QUERIES[key](spark, SF)
    names, want = duck_rows(duck, Q.ORACLE[key])
    assert sorted(got.columns) == sorted(names)
    assert digest(spark_rows(got)) == digest(want)


@pytest.mark.parametrize("key", sorted(Q.QUERIES))
def test_promised_columns_come_first(spark, key):
    got = Q.QUERIES[key](spark, SF)
    promised = COLUMNS[key].split(", ")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema][: len(promised)] == promised


def test_entry_registers_all(spark):
    assert set(COLUMNS) | {"pipeline"} <= set(E.queries())
    assert set(Q.ORACLE) <= set(E.oracle_sql())
