"""Alert building as DataFrame operators (E7, E8, M2) over the Column functions.

All of these are narrow transformations (one ``select`` per step, no shuffle), so they run the same
in batch and in Structured Streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalert.constants import EMOTION_CATEGORIES
from tonalert.functions import entities as E
from tonalert.functions.core import bind
from tonalert.functions import text as T
from tonalert.operators.joins import checked_broadcast

GOOD_WORDS = [w for w, c in EMOTION_CATEGORIES.items() if c == "good emotion"]
BAD_WORDS = [w for w, c in EMOTION_CATEGORIES.items() if c == "bad emotion"]


def alert_pairs(df: DataFrame, key: str = "doc_id", tokens: str = "tokens", tags: str | None = None,
                entities: str | None = "entities", sentiment: str = "sentiment",
                score: str = "sentiment_score", sentence: str = "sentence", salt: int = 0) -> DataFrame:
    """E1 (unless ``entities`` is given) -> E4 prompt and E6 alert as ``input_text``/``target_text``."""
    if entities is None or entities not in df.columns:
        df = df.withColumn("entities", E.extract_entities(tokens, tags))
        entities = "entities"
    if sentence not in df.columns:
        df = df.withColumn(sentence, T.join_tokens(tokens))
    return df.withColumns({
        "input_text": E.build_prompt(entities, sentiment, sentence),
        "target_text": E.build_alert(entities, sentiment, score, key, salt=salt),
    })


def lexicon_counts(toks) -> Column:
    """``array(pos, neg)``: counts of good and bad signals among normalised tokens (listed words
    plus the ``<good`` / ``<bad`` halves that the emotion tags leave after tokenising).

    One pass over all tokens keeps the listed ones (usually a handful); both counts then read
    only those. ``isin`` over more than ten literals is a hash-set test (InSet)."""
    toks = F.col(toks) if isinstance(toks, str) else toks
    good = GOOD_WORDS + ["<good"]
    bad = BAD_WORDS + ["<bad"]
    hits = F.filter(toks, lambda w: w.isin(good + bad))
    return bind(hits, lambda h: F.array(F.size(F.filter(h, lambda w: w.isin(good))),
                                        F.size(F.filter(h, lambda w: w.isin(bad)))))


def lexicon_sentiment(toks) -> Column:
    """M2: ``struct<label, score, pos, neg>``: pos > neg positive, neg > pos negative, else
    neutral; score = max(pos, neg) / (pos + neg), 0.5 with no signal."""
    def from_counts(pn):
        pos, neg = pn[0], pn[1]
        label = F.when(pos > neg, F.lit("positive")).when(neg > pos, F.lit("negative")).otherwise(F.lit("neutral"))
        score = F.when(pos + neg == 0, F.lit(0.5)).otherwise(F.greatest(pos, neg) / (pos + neg))
        return F.struct(label.alias("label"), score.cast("double").alias("score"), pos.alias("pos"), neg.alias("neg"))

    # The counts are bound once; the label and score read them several times.
    return bind(lexicon_counts(toks), from_counts)


def fuse_caption(df: DataFrame, caps: DataFrame, on, text: str = "text", caption: str = "caption") -> DataFrame:
    """Left join captions on the key and append the caption to the text. Captions are
    broadcast while their measured size allows, so texts are not shuffled by a key that few values share."""
    joined = df.join(checked_broadcast(caps, materialize=False), on=on, how="left")
    return joined.withColumn("fused", F.concat_ws(" ", F.col(text), F.col(caption)))


def alerts_from_text(df: DataFrame, key: str = "doc_id", text: str = "text", tags: str = "ner_tags",
                     coded: bool = True, salt: int = 0, tokens: str | None = None) -> DataFrame:
    """R1's row-wise chain: T16 -> M2 for the tone, supplied tags -> E1 for the entities, then E6.

    The tags belong to the white-space tokens of the text; a stream that already carries those
    tokens names them in ``tokens`` and they are not split again. Every step is a single-row
    expression, so the same function serves a static DataFrame and a streaming one.
    """
    # Two projections: the tone struct is computed once, then read three times (Catalyst keeps
    # the projections apart because the struct is not cheap to recompute).
    scored = df.select(
        key,
        lexicon_sentiment(T.normalize_tweet(text)).alias("_tone"),
        E.extract_entities(F.col(tokens) if tokens else T.words(text), tags, coded).alias("_ents"),
    )
    return scored.select(
        key,
        F.col("_tone.label").alias("sentiment"),
        F.col("_tone.score").alias("sentiment_score"),
        E.build_alert("_ents", "_tone.label", "_tone.score", key, salt=salt).alias("alert"),
    )


def entity_sentiment(alerts: DataFrame, entities: str = "entities", sentiment: str = "sentiment",
                     score: str = "sentiment_score") -> DataFrame:
    """R2: per (entity, tag): mentions, share of negative mentions and mean score.

    The explode stays where the rows are; the grouping is partial-then-final, so a very frequent
    entity is combined map-side before the shuffle.
    """
    e = alerts.select(F.explode(E.clean_entities(entities)).alias("e"), sentiment, score)
    neg = F.when(F.col(sentiment) == "negative", F.lit(1)).otherwise(F.lit(0))
    return e.groupBy(F.col("e.entity").alias("entity"), F.col("e.tag").alias("tag")).agg(
        F.count(F.lit(1)).alias("mentions"),
        F.sum(neg).alias("negatives"),
        F.avg(neg.cast("double")).alias("share_negative"),
        F.avg(score).alias("mean_score"),
    )


def alert_pipeline(df: DataFrame, caps: DataFrame, gazetteer: DataFrame, on, key: str = "doc_id", text: str = "text",
                   salt: int = 0) -> DataFrame:
    """From raw text to an alert: caption joined and fused (E8), tokens tagged from a gazetteer (E9),
    spans decoded (E1), tone from the lexicon (M2), alert (E6)."""
    from tonalert.operators.models import tag_rows

    fused = fuse_caption(df, caps, on, text).select(key, F.col("fused").alias("_text"))
    rows = tag_rows(fused.withColumn("_tokens", T.words("_text")), gazetteer, "_tokens", "_tags")
    return alerts_from_text(rows, key, "_text", "_tags", coded=False, salt=salt, tokens="_tokens")


def alerts_from_words(df: DataFrame, kinds: dict[str, str], key: str = "doc_id", text: str = "text", salt: int = 0) -> DataFrame:
    """The untagged form for streams: entities come from a small supplied dictionary word -> kind
    (E9's rule in the row, no join), so rows need no tags and nothing is stateful."""
    listed = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    tokens = T.words(F.coalesce(F.col(text), F.lit("")))

    def tagged(words):
        def kind(i):
            return F.element_at(listed, F.get(words, i))

        def tag(w, i):
            own = F.element_at(listed, w)
            mark = F.when(F.coalesce(kind(i - 1) == own, F.lit(False)), F.lit("I-")).otherwise(F.lit("B-"))
            return F.coalesce(F.concat(mark, own), F.lit("O"))

        return F.transform(words, tag)

    rows = df.select(key, text, tokens.alias("_tokens")).select(key, text, "_tokens", tagged(F.col("_tokens")).alias("_tags"))
    return alerts_from_text(rows, key, text, "_tags", coded=False, salt=salt, tokens="_tokens")
