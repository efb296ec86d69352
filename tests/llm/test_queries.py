"""Registered queries: their SQL where there is one, and what their contracts fix."""

import __spark_entry__ as entry
import check
from clearspark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_queries_match_their_sql(spark):
    con = check.connect(FOLDER)
    for name, sql in ORACLES.items():
        assert check.differences(QUERIES[name](spark, FOLDER), con, sql) == ""


def test_one_query_for_each_operator():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_columns_of_the_contracts(spark):
    shown = {
        "op1": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
        "op3": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
        "op4": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        "op5": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op6": "doc_id bigint, n_shingles bigint, component_id bigint",
        "op7": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
        "op8": "query_id bigint, rank int, vec_id bigint, score double",
        "op10": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        "op11": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
        "op12": "page_id bigint, url string, text string, n_chars bigint",
        "op13": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    }
    for n, columns in shown.items():
        name = next(q for q in QUERIES if q.startswith(f"{n}_"))
        found = dict(QUERIES[name](spark, FOLDER).dtypes)
        for column in columns.split(", "):
            own, kind = column.split()
            assert found[own] == kind, (name, own)
