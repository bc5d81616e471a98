"""Registered queries: contract columns, and DuckDB where SQL can express them."""

import pytest

from orderlens.llm.oracle import oracle
from orderlens.llm.queries import queries
from tools.oracle_check import duck, rows_of

COLUMNS = {
    "op1_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op6_quality_rules": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op7_decontamination": {
        "doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean",
    },
    "op8_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op11_collocations": {
        "lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint",
    },
    "op12_periodic_runs": {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
        "runs_sha256": "string", "collapsed_sha256": "string",
    },
    "op13_lm_scores": {
        "doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
        "base_score": "double", "score": "double",
    },
}


def test_fourteen_queries():
    names = set(queries())
    assert {int(n[2:].split("_")[0]) for n in names if n != "pipeline"} == set(range(1, 14)) and "pipeline" in names
    assert set(oracle()) <= names


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, sf, name):
    assert COLUMNS[name].items() <= dict(queries()[name](spark, sf).dtypes).items()


@pytest.mark.parametrize("name", sorted(oracle()))
def test_query_matches_oracle(spark, sf, name):
    st, ot = queries()[name](spark, sf).toArrow(), duck(sf).sql(oracle()[name]).to_arrow_table()
    assert rows_of(st) == rows_of(ot) and st.num_rows > 0


def test_every_document_has_one_row(spark, sf, docs):
    for name, query in queries().items():
        if name in ("op2_html_text", "op5_revisits", "op9_chat", "op11_collocations", "pipeline"):
            continue
        assert sorted(r.doc_id for r in query(spark, sf).select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect()), name
