"""The pipeline against its SQL (stages 1 to 4) and a tokenizer library (stage 5)."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tonalert.llm import sql

SF = "/root/testdata/sf0.001"


def stages_in_sql(sf):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    con.execute(f"CREATE TABLE s1 AS WITH {sql.quality_features_ctes('documents')}, {sql.quality_verdict_ctes()} "
                "SELECT d.* FROM verdict v JOIN documents d USING (doc_id) WHERE kept")
    rows = "src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {})"
    con.execute(f"CREATE TABLE s2 AS WITH {rows.format('s1')}, {sql.line_ctes('src')} SELECT doc_id, t AS text FROM shorter")
    con.execute(f"CREATE TABLE s3 AS WITH RECURSIVE {rows.format('s2')}, {sql.near_ctes('src', cp.NEAR_PERCENT)} "
                "SELECT s2.* FROM near JOIN s2 USING (doc_id) WHERE near.doc_id = component_id")
    con.execute(f"CREATE TABLE s4 AS WITH {rows.format('s3')}, {sql.hit_ctes('src')} SELECT s3.* FROM hits JOIN s3 USING (doc_id) WHERE n_hit = 0")
    return con


@pytest.fixture(scope="module")
def con():
    return stages_in_sql(SF)


def test_stages_match_sql(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(cp.STAGES[:-1], 1):
        docs = cp.stored(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        got = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        assert got == sorted(con.execute(f"SELECT doc_id, text FROM s{k}").fetchall()), name


def test_last_stage_matches_tokenizer_library(spark, con):
    import public_tokenizers as P
    import tiktoken

    from tonalert.llm.bpe import read_ranks

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for i, t in con.execute("SELECT doc_id, text FROM s4").fetchall():
        ids = enc.encode_ordinary(t)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = cp.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_stages_take_nulls_and_no_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    long = " ".join(f"w{i}" for i in range(80))
    cases = [[], [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", 0), (3, long, None, None, None), (3, long, None, None, None)]]
    for rows in cases:
        docs = spark.createDataFrame(rows, schema)
        for _, stage in cp.STAGES[1:-1]:
            assert stage(spark, docs, SF).count() == len(rows)
        kept = cp.quality_rules(spark, docs, SF).collect()
        assert [r["doc_id"] for r in kept] == [3, 3][: len(rows)]
        assert cp.byte_bpe(spark, docs, SF).count() == len(rows)


def test_near_dedup_drops_copies_from_four_fifths(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, similar = [], {}
    for k in range(60):  # pairs of 0.76 to 0.87 by their changed tail
        base = [word() for _ in range(204)]
        cut = rng.randint(14, 26)
        copy = base[:-cut] + [word() for _ in range(cut)]
        a, b = ({tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (base, copy))
        similar[2 * k] = (100 * len(a & b), len(a | b))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    dropped = {k + 1 for k, (both, union) in similar.items() if both >= 80 * union}
    assert any(80 * union <= both < 85 * union for both, union in similar.values())
    assert any(both < 80 * union for both, union in similar.values())
    kept = cp.near_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), SF).collect()
    assert {i for i, _ in rows} - {r["doc_id"] for r in kept} == dropped


def test_near_links_at_the_lower_threshold():
    """Bands and sketches let pairs at the threshold through (brute force over planted sets)."""
    from tonalert.llm import superminhash as sm

    rng = np.random.default_rng(4)
    n_bands, n_rows, max_differ = sm.BANDING[80]
    pairs, both, own = 2000, 160, 20  # 160 of 200 shared
    pool = rng.integers(0, 1 << 63, (pairs, both + 2 * own), dtype=np.uint64)
    sets = np.stack([pool[:, :both + own], np.concatenate([pool[:, :both], pool[:, both + own:]], axis=1)], axis=1)
    first = np.arange(2 * pairs + 1) * (both + own)
    sig = sm.signatures(sets.reshape(-1), first, n_bands * n_rows).reshape(pairs, 2, n_bands, n_rows)
    same = sig[:, 0] == sig[:, 1]
    assert same.all(axis=2).any(axis=1).sum() >= pairs - 1
    bits = sm.mix(sig.reshape(pairs, 2, -1).view(np.uint64)) & np.uint64(3)
    assert ((bits[:, 0] != bits[:, 1]).sum(axis=1) <= max_differ).all()


def test_stages_keep_columns_of_any_name(spark):
    """Names that stages and operators use themselves pass through with their own values."""
    names = ["_id", "_row", "_lines", "_s", "_all", "row", "row_hash", "stratum", "n_words", "n_lines", "n_dropped", "kept", "f_symbols", "base_failed", "a.b"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    for name, stage in cp.STAGES[:-1]:
        docs, named = cp.stored(stage(spark, docs, SF), f"test-{name}"), cp.stored(stage(spark, named, SF), f"test-{name}")
        assert named.columns == [*docs.columns, *names], name
        rows = named.collect()
        assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted((r["doc_id"], r["text"]) for r in docs.collect()), name
        assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names), name
