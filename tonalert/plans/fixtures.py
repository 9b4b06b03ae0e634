"""Input tables derived from the supplied parquet tables (FIXTURES.md F1-F9), in Spark.

Every fixture is a pure function of row keys, so DuckDB can build the same rows
(``tonalert.plans.sqltext``). Unlike FIXTURES.md, texts are used whole: F1 appends its suffix to
the full document and F2 tags every token, not a prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonalert.functions import entities as E
from tonalert.functions import text as T
from tonalert.operators.joins import checked_broadcast
from tonalert.sources.io import spread

# FIXED VALUES for the fixtures (FIXTURES.md F1 and F2).
TWEET_SUFFIXES = [
    " @User_1 can't stop",
    "\tsee http://ex.org/a?b=1#c www.x.org awwww",
    " #Topic U gotta love it!!",
    " **sad** x **Hug** **zzz** **open",
    " sooooo allll 1000 \U0001F600\U0001F680",
    " the sun's out, it's fine… \"ok\"? ",
    " don't, mother-in-law's pls",
    "   ",
]
TAG_PATTERN = [0, 1, 2, 2, 0, 3, 4, 0, 5, 1, 8, 7, 8, 3, 2, 0, 4]
LONG_SPAN_EVERY, LONG_SPAN_AT = 50, 7  # these documents are one span from end to end
SPLIT_SEED = 42
TRAIN_FRACTION = 0.8
MISSING_CAPTIONS = 10  # keys beyond the captions, so that some rows find none


# Text-heavy tables whose per-row work dominates: spread over the cluster when a scan yields
# too few partitions (a no-op for inputs made of many files).
# Table -> its row key, used to hash-partition.
_SPREAD = {"documents": "doc_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, key=_SPREAD[name]) if name in _SPREAD else df


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 ``tweets(doc_id, raw)``: the whole text plus one of eight suffixes."""
    sfx = F.array(*[F.lit(s) for s in TWEET_SUFFIXES])
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.concat(F.coalesce("text", F.lit("")), F.element_at(sfx, (F.pmod("doc_id", F.lit(8)) + 1).cast("int"))).alias("raw"),
    )


def _sentiment_cols():
    label = (
        F.when(F.col("toxic") == 1, F.lit("negative"))
        .when(F.col("quality") == 1, F.lit("positive"))
        .otherwise(F.lit("neutral"))
    )
    score = (F.pmod(F.col("doc_id") * 37, F.lit(101)) / F.lit(100.0)).cast("double")
    return label.alias("sentiment"), score.alias("sentiment_score")


def tagged(spark: SparkSession, sf_dir: str, keep_text: bool = False, with_sentiment: bool = False,
           docs: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """F2 as arrays ``tagged(doc_id, tokens, ner_tags)``: every token, tag codes by a rule.

    ``with_sentiment`` adds F4's columns by joining the small ``labels`` table onto the raw
    document rows first, so the derived arrays are never shuffled.
    """
    pat = F.array(*[F.lit(x) for x in TAG_PATTERN])
    # ``docs`` replaces the documents table (it needs doc_id and text); ``carry`` keeps its columns.
    docs = (table(spark, sf_dir, "documents") if docs is None else docs).select("doc_id", "text", *carry)
    extra = [F.col(c) for c in carry]
    if with_sentiment:
        # Size-checked broadcast: the document texts stay where they are unless the labels
        # outgrow the limit (then a shuffle join, as a larger table needs anyway).
        labels = checked_broadcast(table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality"), materialize=False)
        docs = docs.join(labels, "doc_id", "left")
        extra += list(_sentiment_cols())
    if keep_text:
        extra.append(F.col("text"))
    toks = T.words(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", toks.alias("tokens"), *extra)
    rest = [c for c in rows.columns if c not in ("doc_id", "tokens")]
    # Tag i is PAT[(doc_id*5 + i) mod 17]: the pattern repeated, read from offset (doc_id*5) mod 17
    # for as many tokens as there are. Native array functions, no lambda per token.
    period = len(TAG_PATTERN)
    n = F.size("tokens")
    offset = F.pmod(F.col("doc_id") * 5, F.lit(period)).cast("int")
    repeated = F.flatten(F.array_repeat(pat, (F.floor(n / period) + 2).cast("int")))
    one_span = F.slice(F.concat(F.array(F.lit(1)), F.array_repeat(F.lit(2), n)), 1, n)
    by_rule = F.slice(repeated, offset + 1, n)
    tags = F.when(F.pmod("doc_id", F.lit(LONG_SPAN_EVERY)) == LONG_SPAN_AT, one_span).otherwise(by_rule)
    return rows.select("doc_id", "tokens", tags.alias("ner_tags"), *rest)


def tagged_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 exploded ``(doc_id, pos, tok, tag)``."""
    z = F.arrays_zip(F.col("tokens").alias("tok"), F.col("ner_tags").alias("tag"))
    return tagged(spark, sf_dir).select("doc_id", F.posexplode(z).alias("pos", "t")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "t.tok", F.col("t.tag").cast("bigint").alias("tag")
    )


def doc_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 ``doc_sentiment(doc_id, sentiment, sentiment_score)``."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select("doc_id", *_sentiment_cols())


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 ``logits(doc_id, x, y)``: a logit and a 0/2 label per labelled document."""
    labels = table(spark, sf_dir, "labels")
    x = ((F.pmod(F.col("doc_id") * 13, F.lit(21)) - 10) / F.lit(5.0)).cast("double")
    y = F.when(F.col("quality") == 1, F.lit(2)).otherwise(F.lit(0)).cast("bigint")
    return labels.select("doc_id", x.alias("x"), y.alias("y"))


def caption_key(spark: SparkSession, sf_dir: str):
    """Which caption a document has: every caption is used, and some keys have none."""
    n = table(spark, sf_dir, "benchmark").count()
    return F.pmod("doc_id", F.lit(n + MISSING_CAPTIONS))


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions keyed by item: ``benchmark(item_id, text)`` read as ``(item_id, caption)``."""
    return table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("caption"))


def alerts_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 spans + F4 labels: ``(doc_id, sentence, entities, sentiment, sentiment_score)``."""
    return tagged(spark, sf_dir, with_sentiment=True).select(
        "doc_id",
        T.join_tokens("tokens").alias("sentence"),
        E.extract_entities("tokens", "ner_tags").alias("entities"),
        "sentiment",
        "sentiment_score",
    )


def alert_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 ``alert_predictions(doc_id, prediction, reference)``: salt 1 against salt 0."""
    a = alerts_input(spark, sf_dir).select(
        "doc_id", "sentiment", "sentiment_score", E.clean_entities("entities").alias("clean"))
    # Entities are cleaned once and read by both alerts.
    return a.select(
        "doc_id",
        E.build_alert("clean", "sentiment", "sentiment_score", "doc_id", salt=1, cleaned=True).alias("prediction"),
        E.build_alert("clean", "sentiment", "sentiment_score", "doc_id", salt=0, cleaned=True).alias("reference"),
    )
