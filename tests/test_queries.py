"""Every registered query against its DuckDB text at sf0.001 (the driver does the same at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tonalert.plans import catalog

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["doc_id", "input_text", "target_text"]


def test_every_sql_query_has_a_builder():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr)
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    pairs = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    dtypes = {d[0]: str(d[1]) for d in res.description}
    for f in df.schema.fields:
        assert pairs.get(f.dataType.simpleString()) == dtypes[f.name], (f.name, f.dataType, dtypes[f.name])
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() >= 1
