"""The registered corpus queries on the smallest tables, against their SQL twins where there are any."""

import duckdb
import pytest

import __spark_entry__ as E
from bibliospark.llm.queries import ORACLE, QUERIES
from scripts.check_oracle import TABLES, rows_of

from .helpers import SF

COLUMNS = {
    "op1_ngram_join": {"doc_id", "n_shingles", "component_id"},
    "op2_decontaminate": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op3_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op4_license_scan": {"doc_id", "license", "containment", "first_word"},
    "op5_ann": {"query_id", "rank", "vec_id", "score"},
    "op6_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op7_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op8_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op9_line_dedup": {"doc_id", "n_lines", "n_dropped", "kept_sha256"},
    "op10_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op11_prefix_trie": {
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    },
    "op12_lexical_search": {"item_id", "rank", "doc_id", "score"},
    "op13_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(COLUMNS) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    assert set(df.columns) == COLUMNS[name]
    got = [tuple(r) for r in df.collect()]
    assert got
    if name in ORACLE:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        cur = con.execute(ORACLE[name])
        names = [d[0] for d in cur.description]
        assert rows_of(df.columns, got) == rows_of(names, cur.fetchall())
