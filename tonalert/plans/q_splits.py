"""Queries for splits, samples, set operations and semi/anti joins.

Documents stand in for tweets and images; ``source`` stands in for the image a caption belongs
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.functions import text as TX
from tonalert.operators import joins as J
from tonalert.operators import splits as S
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.registry import normalise, register, with_ctes

SEED = fx.SPLIT_SEED
SAMPLE_SEED = 7
_TEXT = "coalesce(d.text, '')"


def _md5(key, seed):
    return f"md5(CAST({key} AS VARCHAR) || ':{seed}')"


def _docs(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents")


@register("l01_split_exact", with_ctes(q.splits_cte()) + "SELECT doc_id, split FROM splits")
def l01_split_exact(spark, sf_dir):
    return normalise(S.split_exact(_docs(spark, sf_dir).select("doc_id"), "doc_id", fx.TRAIN_FRACTION, SEED))


_GROUPS = (
    f"g AS (SELECT DISTINCT source FROM documents), "
    f"gr AS (SELECT source, row_number() OVER (ORDER BY {_md5('source', SEED)}, source) AS rk, count(*) OVER () AS n FROM g), "
    "glab AS (SELECT source, CASE WHEN rk <= CAST(floor(0.8 * n) AS BIGINT) THEN 'train' "
    "WHEN rk <= CAST(floor(0.8 * n) AS BIGINT) + CAST(floor(0.1 * n) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM gr)"
)


def _groups(spark, sf_dir):
    return S.split_groups(_docs(spark, sf_dir).select("doc_id", "source"), "source", (0.8, 0.1, 0.1), SEED)


@register(
    "l02_split_groups",
    with_ctes(_GROUPS) + "SELECT d.doc_id, d.source, glab.split FROM documents d LEFT JOIN glab ON d.source IS NOT DISTINCT FROM glab.source",
)
def l02_split_groups(spark, sf_dir):
    return normalise(_groups(spark, sf_dir).select("doc_id", "source", "split"))


@register(
    "l03_split_nested",
    f"WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_md5('doc_id', SEED)}, doc_id) AS rk, count(*) OVER () AS n "
    "FROM documents), sub AS (SELECT doc_id FROM r WHERE rk <= CAST(floor(0.1 * n) AS BIGINT)), "
    f"r2 AS (SELECT doc_id, row_number() OVER (ORDER BY {_md5('doc_id', SEED + 1)}, doc_id) AS rk, count(*) OVER () AS n FROM sub) "
    "SELECT doc_id, CASE WHEN rk <= CAST(floor(0.8 * n) AS BIGINT) THEN 'train' ELSE 'val' END AS split FROM r2",
)
def l03_split_nested(spark, sf_dir):
    return normalise(S.split_nested(_docs(spark, sf_dir).select("doc_id"), "doc_id", 0.1, 0.8, SEED))


_SAMPLE = (
    f"smp AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {_md5('doc_id', SAMPLE_SEED)}, doc_id) AS rk, "
    "count(*) OVER () AS n FROM documents) WHERE rk <= CAST(round(0.1 * n) AS BIGINT))"
)


@register("l04_sample_fraction", with_ctes(_SAMPLE) + "SELECT doc_id FROM smp")
def l04_sample_fraction(spark, sf_dir):
    return normalise(S.sample_fraction(_docs(spark, sf_dir).select("doc_id"), "doc_id", 0.1, SAMPLE_SEED))


@register("l05_first_files", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 10")
def l05_first_files(spark, sf_dir):
    return normalise(S.first_rows(_docs(spark, sf_dir).select("doc_id", "source"), "doc_id", 10))


@register(
    "l06_shuffle",
    f"SELECT doc_id, row_number() OVER (ORDER BY {_md5('doc_id', SEED)}, doc_id) - 1 AS pos FROM documents",
)
def l06_shuffle(spark, sf_dir):
    return normalise(S.shuffle(_docs(spark, sf_dir).select("doc_id"), "doc_id", SEED))


@register(
    "j01_keep_split",
    with_ctes(_GROUPS) + "SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM glab WHERE split = 'train')",
)
def j01_keep_split(spark, sf_dir):
    train = _groups(spark, sf_dir).filter(F.col("split") == "train").select("source")
    docs = _docs(spark, sf_dir).select("doc_id", "source")
    return normalise(J.keep_split(docs, train, "source"))


@register(
    "j02_not_in",
    with_ctes(q.splits_cte()) + "SELECT d.doc_id, d.lang FROM documents d ANTI JOIN (SELECT doc_id FROM splits "
    "WHERE split = 'train') t ON d.doc_id = t.doc_id",
)
def j02_not_in(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "lang")
    return normalise(J.outside_split(S.split_exact(docs, "doc_id", fx.TRAIN_FRACTION, SEED), "train").drop("split"))


@register(
    "u01_union_splits",
    with_ctes(_GROUPS) + f"SELECT d.doc_id, glab.split, len({q.words(_TEXT)}) AS n_words FROM documents d "
    "LEFT JOIN glab ON d.source IS NOT DISTINCT FROM glab.source",
)
def u01_union_splits(spark, sf_dir):
    """All splits in one pass: the rows carry their split as a column."""
    docs = S.split_groups(_docs(spark, sf_dir).select("doc_id", "source", "text"), "source", (0.8, 0.1, 0.1), SEED)
    return normalise(docs.select("doc_id", "split", F.size(TX.words(F.coalesce("text", F.lit("")))).alias("n_words")))


@register(
    "u02_complement",
    with_ctes(_SAMPLE) + "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM smp)",
)
def u02_complement(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "source")
    marked = S.assign_ranges(docs, "doc_id", SAMPLE_SEED, lambda n: [S.py_round(0.1 * n)], ["in", "out"], "part")
    return normalise(J.outside_split(marked, "in", "part").drop("part"))


_TRAIN_BATCH = 64


@register(
    "l09_batches",
    f"SELECT doc_id, (rn - 1) // {_TRAIN_BATCH} AS batch, (rn - 1) % {_TRAIN_BATCH} AS slot FROM "
    f"(SELECT doc_id, row_number() OVER (ORDER BY {_md5('doc_id', SEED)}, doc_id) AS rn FROM documents)",
)
def l09_batches(spark, sf_dir):
    return normalise(S.batches(_docs(spark, sf_dir).select("doc_id"), "doc_id", _TRAIN_BATCH, SEED))
