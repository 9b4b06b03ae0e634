"""Queries for the streaming operators in their batch form (R1-R3); the stream = batch check is
in tests/test_streaming.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.functions import entities as E
from tonalert.operators.alerts import BAD_WORDS, GOOD_WORDS, alert_pipeline, alerts_from_text, alerts_from_words, entity_sentiment
from tonalert.operators.models import gazetteer_from_spans
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.registry import normalise, register, with_ctes
from tonalert.session import reliable_checkpoint
from tonalert.streaming.streams import bursts, shift_alerts, sentiment_windows, windows_flat


def _stream_rows(spark, sf_dir):
    """``(doc_id, text, ner_tags)``: documents with F2's tag codes (what a tagged stream carries)."""
    return fx.tagged(spark, sf_dir, keep_text=True).select("doc_id", "text", "ner_tags")


def _tone_cte(source="documents"):
    good = q.sql_list(GOOD_WORDS + ["<good"])
    bad = q.sql_list(BAD_WORDS + ["<bad"])
    return (
        f"pre AS (SELECT doc_id, string_split({q.pre_squeeze('text')}, '') AS ch FROM {source}), "
        f"normed AS (SELECT doc_id, list_filter(string_split({q.squeeze_chars('ch')}, ' '), lambda w: w <> '') AS tk FROM pre), "
        f"counted AS (SELECT doc_id, len(list_filter(tk, lambda w: list_contains({good}, w))) AS pos, "
        f"len(list_filter(tk, lambda w: list_contains({bad}, w))) AS neg FROM normed), "
        "doc_sentiment AS (SELECT doc_id, CASE WHEN pos > neg THEN 'positive' WHEN neg > pos THEN 'negative' ELSE 'neutral' END "
        "AS sentiment, CASE WHEN pos + neg = 0 THEN 0.5 ELSE greatest(pos, neg) / (pos + neg) END AS sentiment_score FROM counted)"
    )


@register(
    "r01_stream_alerts",
    with_ctes(_tone_cte(), q.tagged_docs_cte(), q.entity_spans_cte(), q.clean_spans_cte(), q.alerts_cte((0,)))
    + "SELECT doc_id, sentiment, round(sentiment_score, 6) AS sentiment_score, alert_0 AS alert FROM alerts",
)
def r01_stream_alerts(spark, sf_dir):
    rows = fx.tagged(spark, sf_dir, keep_text=True).select("doc_id", "text", "tokens", "ner_tags")
    a = alerts_from_text(rows, "doc_id", "text", "ner_tags", tokens="tokens")
    return normalise(a.select("doc_id", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score"), "alert"))


@register(
    "r02_entity_sentiment",
    with_ctes(q.tagged_docs_cte(), q.entity_spans_cte(), q.clean_spans_cte(), q.doc_sentiment_cte())
    + "SELECT c.entity, c.tag, count(*) AS mentions, CAST(sum(CASE WHEN d.sentiment = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negatives, "
    "round(avg(CASE WHEN d.sentiment = 'negative' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) + 1e-9, 4) AS share_negative, "
    "round(avg(d.sentiment_score) + 1e-9, 4) AS mean_score FROM clean_spans c "
    "JOIN doc_sentiment d ON c.doc_id = d.doc_id GROUP BY c.entity, c.tag",
)
def r02_entity_sentiment(spark, sf_dir):
    # The small constant moves means off rounding ties, which two engines could break differently.
    es = entity_sentiment(fx.alerts_input(spark, sf_dir))
    return normalise(es.select("entity", "tag", "mentions", "negatives", F.round(F.col("share_negative") + 1e-9, 4).alias("share_negative"),
                               F.round(F.col("mean_score") + 1e-9, 4).alias("mean_score")))


@register(
    "r03_sentiment_windows",
    "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS label, count(*) AS n "
    "FROM events GROUP BY 1, 2",
)
def r03_sentiment_windows(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("label"))
    return normalise(windows_flat(sentiment_windows(ev, "ts", "label", "1 day")))


# Mentions with a time: every entity of an alert is mentioned at an hour that follows from the document's number.
_MENTION_HOURS = 13


@register(
    "r02_shift_alerts",
    with_ctes(q.tagged_docs_cte(), q.doc_sentiment_cte(), q.entity_spans_cte(), q.clean_spans_cte())
    + f", m AS (SELECT entity, tag, TIMESTAMP '2024-01-01 00:00:00' + to_hours((doc_id * {_MENTION_HOURS})::BIGINT % 480) AS ts, "
    "(sentiment = 'negative')::INT AS negative FROM clean_spans JOIN doc_sentiment USING (doc_id)), "
    "per AS (SELECT entity, tag, date_trunc('day', ts) AS w, count(*) AS mentions, sum(negative)::BIGINT AS negatives FROM m GROUP BY ALL), "
    "pairs AS (SELECT *, lag(mentions) OVER o AS before_mentions, lag(negatives) OVER o AS before_negatives FROM per WINDOW o AS (PARTITION BY entity, tag ORDER BY w)) "
    "SELECT entity, tag, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, mentions, negatives, before_mentions, before_negatives FROM pairs "
    "WHERE mentions >= 2 AND before_mentions >= 2 AND abs(negatives / mentions - before_negatives / before_mentions) >= 0.3 - 1e-12",
)
def r02_shift_alerts(spark, sf_dir):
    """R2's alerts in batch form: days in which the tone about an entity shifts."""
    a = fx.tagged(spark, sf_dir, with_sentiment=True).select("doc_id", "sentiment", F.explode(E.clean_entities(E.extract_entities("tokens", "ner_tags"))).alias("e"))
    hour = F.pmod(F.col("doc_id") * _MENTION_HOURS, F.lit(480)).cast("int")
    m = a.select(F.make_dt_interval(hours=hour).alias("h"), "e.entity", "e.tag", (F.col("sentiment") == "negative").cast("int").alias("negative"))
    m = m.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp") + F.col("h"))
    s = shift_alerts(m, least=2)
    return normalise(s.select("entity", "tag", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "mentions", "negatives", "before_mentions", "before_negatives"))


@register(
    "r03_bursts",
    "WITH e AS (SELECT event_type AS label, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS before FROM events WHERE ts IS NOT NULL), "
    "runs AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 20 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY ts "
    "ROWS UNBOUNDED PRECEDING) AS run FROM e) "
    "SELECT label, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last, count(*) AS n FROM runs GROUP BY label, run",
)
def r03_bursts(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("label"))
    b = bursts(ev, "ts", "label", "20 minutes")
    return normalise(b.select("label", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("first", "last")], "n"))


_KINDS = {"idiot": "PER", "the": "MISC", "der": "ORG", "de": "LOC", "la": "LOC"}
_GAZETTEER = (
    "gaz AS (SELECT tok, min(kind) AS kind FROM (SELECT unnest(string_split(entity, ' ')) AS tok, tag AS kind FROM spans) "
    "WHERE tok <> '' GROUP BY tok), "
    f"fused AS (SELECT d.doc_id, concat_ws(' ', d.text, b.text) AS text FROM documents d LEFT JOIN benchmark b ON b.item_id = {q.CAPTION_KEY}), "
)


def _chain_ctes(source):
    """Alerts from raw text: words of ``source`` tagged by ``gaz``, spans, tone, alert."""
    words = (
        f"tl AS (SELECT doc_id, {q.words('text')} AS toks FROM {source}), "
        "tw AS (SELECT doc_id, CAST(p - 1 AS BIGINT) AS pos, toks[p] AS tok, CASE WHEN p > 1 THEN toks[p - 1] END AS prev "
        "FROM (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS p FROM tl)), "
    )
    named = ("SELECT tw.doc_id, tw.pos, tw.tok, CASE WHEN g.kind IS NULL THEN 'O' WHEN gp.kind = g.kind THEN 'I-' || g.kind "
             "ELSE 'B-' || g.kind END AS name FROM tw LEFT JOIN gaz g ON tw.tok = g.tok LEFT JOIN gaz gp ON tw.prev = gp.tok")
    return words + ", ".join([q.entity_spans_cte(named, "_x"), q.clean_spans_cte("_x"), _tone_cte(source), q.alerts_cte((0,))])


_ALERT_COLUMNS = " SELECT doc_id, sentiment, round(sentiment_score, 6) AS sentiment_score, alert_0 AS alert FROM alerts"


def _rounded(a):
    return normalise(a.select("doc_id", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score"), "alert"))


@register(
    "x01_alert_pipeline",
    with_ctes(q.tagged_docs_cte(), q.entity_spans_cte()) + ", " + _GAZETTEER + _chain_ctes("fused") + _ALERT_COLUMNS,
)
def x01_alert_pipeline(spark, sf_dir):
    """End to end: caption, fused text, entities by a gazetteer, tone, alert."""
    t = fx.tagged(spark, sf_dir)
    spans = t.select(F.explode(E.extract_entities("tokens", "ner_tags")).alias("e")).select("e.entity", "e.tag")
    gaz = reliable_checkpoint(gazetteer_from_spans(spans))
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("item_id", fx.caption_key(spark, sf_dir))
    return _rounded(alert_pipeline(docs, fx.captions(spark, sf_dir), gaz, "item_id"))


@register(
    "x02_alerts_from_words",
    "WITH gaz(tok, kind) AS (VALUES " + ", ".join(f"('{w}', '{k}')" for w, k in _KINDS.items()) + "), " + _chain_ctes("documents") + _ALERT_COLUMNS,
)
def x02_alerts_from_words(spark, sf_dir):
    """The untagged stream's chain in batch form."""
    return _rounded(alerts_from_words(fx.table(spark, sf_dir, "documents").select("doc_id", "text"), _KINDS))
