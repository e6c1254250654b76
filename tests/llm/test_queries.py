"""The registered queries on the smallest given tables: agreement with their
SQL, or the contract's columns and a row for every row."""

import duckdb
import pytest

from adlake.llm import queries as Q
from tests.conftest import SMOKE
from tools.check_oracle import TABLES, compare

CONTRACT = {
    "op1": ["doc_id long", "n_shingles long", "component_id long"],
    "op2": ["doc_id long", "n_email long", "n_ip long", "n_card long", "n_phone long", "base_sha256 string", "spans string"],
    "op3": ["doc_id long", "n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"],
    "op4": ["doc_id long", "n_words long", "n_hit long", "n_items long", "items_sha256 string", "contaminated boolean"],
    "op5": ["doc_id long", "n_assign long", "n_access long", "n_hex long", "base_sha256 string", "spans string"],
    "op6": ["doc_id long", "n_lines long", "n_removed long"],
    "op7": ["page_id long", "payload_bytes long", "payload_digest string", "record_type string", "refers_to long"],
    "op8": ["doc_id long", "n_words long", "word_chars long", "n_symbols long", "n_dup_lines long", "n_repeat_words long", "base_failed boolean", "kept boolean"],
    "op9": ["doc_id long", "n_removed long"],
    "op13": ["conv_id long", "depth long", "parent_conv_id long", "n_convs long", "n_children long", "n_leaves long", "saved_tokens long", "ends_sha256 string"],
    "op11": ["query_id long", "rank int", "vec_id long", "score long"],
    "op12": ["doc_id long", "n_runs long", "start long", "length long", "period long", "exponent_milli long", "runs_sha256 string", "collapsed_sha256 string"],
    "op10": ["doc_id long", "size long", "source_size long", "target double", "taken long"],
}
ROWS = {
    "op7": "SELECT count(*) FROM pages",
    "op13": None,  # as many as there are nodes; its SQL tells
    "op11": "SELECT sum(least(10, (SELECT count(*) FROM embeddings) - 1)) FROM embeddings WHERE vec_id % 100 = 0",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_there_is_one_query_for_each_operator():
    assert sorted(name.split("_")[0] for name in Q.queries()) == sorted(CONTRACT)
    assert set(Q.oracle_sql()) <= set(Q.queries())


@pytest.mark.parametrize("name", list(Q.queries()))
def test_query(spark, con, name):
    df = Q.queries()[name](spark, SMOKE)
    kinds = {c: {"bigint": "long"}.get(k, k) for c, k in df.dtypes}
    for field in CONTRACT[name.split("_")[0]]:
        column, kind = field.split()
        assert kinds[column] == kind, field
    got = df.toArrow()
    rows = ROWS.get(name.split("_")[0], "SELECT count(*) FROM documents")
    assert rows is None or got.num_rows == con.sql(rows).fetchall()[0][0]
    if name in Q.oracle_sql():
        res = compare(got, con.sql(Q.oracle_sql()[name]).to_arrow_table())
        assert res["ok"], res
