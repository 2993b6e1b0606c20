"""The registered queries: those with SQL equal DuckDB's rows, the others hold
their contracts' shape, on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import canon, duck  # noqa: E402
from tidemark.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op3_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_toxicity": "doc_id held_out score predicted",
    "op5_label_propagation": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op12_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(queries.SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert canon(df.columns, rows) == canon(columns, cur.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_the_columns_and_a_row_a_document(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name].split()
    ids = sorted(r.doc_id for r in df.select("doc_id").distinct().collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


def test_every_operator_is_registered():
    assert {int(q.split("_")[0][2:]) for q in queries.QUERIES} == set(range(1, 14))


def test_whitening_has_the_columns_and_eight_rows_a_vector(spark):
    df = queries.QUERIES["op11_whitening"](spark, SF)
    assert df.columns == "vec_id component n deviation whitened explained identity_error".split()
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    rows = df.collect()
    assert len(rows) == 8 * n and {r.n for r in rows} == {n} and rows[0].identity_error < 1e-9
