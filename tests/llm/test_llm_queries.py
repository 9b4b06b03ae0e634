"""Every query with SQL against DuckDB over whole tables; shapes of the others."""

import os

import duckdb
import pytest

from tonalert.llm import queries as q

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
RESULT = {
    "op3": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op5": [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")],
    "op8": [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
    "op13": [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op9": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = q.queries()[name](spark, SF)
    res = duck.execute(q.oracle_sql()[name])
    names, types = [d[0] for d in res.description], {d[0]: str(d[1]) for d in res.description}
    assert sorted(df.columns) == sorted(names)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [names.index(c) for c in df.columns]
    want = sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == want


def test_one_query_per_operator():
    assert [sum(n.startswith(f"op{k}_") for n in q.queries()) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_rows_only_queries(spark, name):
    df = q.queries()[name](spark, SF)
    assert df.dtypes == RESULT[name.split("_")[0]]
    ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    assert sorted(r[0] for r in df.select("doc_id").collect()) == sorted(r[0] for r in ids.collect())


def test_no_scratch_beside_the_shared_folder():
    assert not [d for d in os.listdir(".") if d.startswith("tonalert-")]
