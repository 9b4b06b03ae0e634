"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``. Rows are
told apart by their id and the hash of their text, so repeated ids with different texts are judged
each by itself. Lists of rejected rows are broadcast only if measured small; beyond that they are
joined by that key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonalert.llm import quality_rules as qr
from tonalert.llm.common import stored, table, text_or_empty
from tonalert.llm.decontaminate import contaminated
from tonalert.llm.line_dedup import drop_lines, keep_bitmaps
from tonalert.llm.q_models import bpe_digests, tokenizer
from tonalert.llm.superminhash import near_duplicates
from tonalert.operators.joins import checked_broadcast

# Stages call texts near copies from a Jaccard similarity of 0.8; 0.85 is the contract of query op1 alone.
NEAR_PERCENT = 80


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` less the rows of ``rejected`` (doc_id, row_hash)."""
    side = checked_broadcast(stored(rejected.select("doc_id", "row_hash").distinct(), "rejected"), materialize=False)
    own = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("row_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    match = own["doc_id"].eqNullSafe(side["doc_id"]) & (own["row_hash"] == side["row_hash"])
    return own.join(side, match, "left_anti").select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the certified rules reject go. Texts are measured once, in one pass without
    a shuffle; the rules are fitted on the labelled ones among them."""
    rows = docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    features = stored(qr.with_features(rows).drop("text"), "quality-features")
    rules = qr.thresholds(features, table(spark, sf_dir, "labels"))
    return qr.with_verdict(features, rules).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: lines that many documents share stay in one; ``n_chars`` follows the text. A
    document that loses all its lines stays, with an empty text."""
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = drop_lines(rows, keep_bitmaps(docs))

    def own(c):
        if c == "text":
            return F.col("text")
        kept = F.col(f"row.`{c}`")
        if c == "n_chars":
            kept = F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(kept)
        return kept.alias(c)

    return out.select(*[own(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: of each group of near-duplicates (NEAR_PERCENT of five-word shingles or more) the
    smallest doc_id stays."""
    return _without(docs, near_duplicates(docs, NEAR_PERCENT).where(~F.col("kept")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: documents that hold a benchmark window go."""
    return _without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")).where(F.size("hit") > 0))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: token counts and digests of the ids and of the decoded bytes."""
    return bpe_digests(tokenizer(spark), docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# The last stage has no SQL form; tests hold the others against SQL and the last against a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
