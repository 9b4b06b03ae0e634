"""Queries for entity spans, prompts and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.functions import arrays as A
from tonalert.functions import entities as E
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.registry import normalise, register, with_ctes

_SPANS = with_ctes(q.tagged_docs_cte(), q.entity_spans_cte())
_CLEAN = with_ctes(q.tagged_docs_cte(), q.entity_spans_cte(), q.clean_spans_cte())


def _spans_exploded(col):
    return F.posexplode(col).alias("n", "e")


@register(
    "e01_extract_entities",
    _SPANS + "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY grp) - 1 AS n, entity, tag FROM spans",
)
def e01_extract_entities(spark, sf_dir):
    t = fx.tagged(spark, sf_dir)
    return normalise(
        t.select("doc_id", _spans_exploded(E.extract_entities("tokens", "ner_tags")))
        .select("doc_id", "n", "e.entity", "e.tag")
    )


@register(
    "e02_clean_entities",
    _CLEAN + "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY grp) - 1 AS n, entity, tag "
    "FROM clean_spans",
)
def e02_clean_entities(spark, sf_dir):
    t = fx.tagged(spark, sf_dir)
    return normalise(
        t.select("doc_id", _spans_exploded(E.clean_entities(E.extract_entities("tokens", "ner_tags"))))
        .select("doc_id", "n", "e.entity", "e.tag")
    )


def _group_sql():
    cols = ", ".join(
        f"coalesce(string_agg(c.entity, ' | ' ORDER BY c.grp) FILTER (WHERE c.tag = '{k}'), '') AS {k.lower()}, "
        f"count(c.entity) FILTER (WHERE c.tag = '{k}') AS n_{k.lower()}"
        for k in E.ENTITY_KINDS
    )
    return _CLEAN + (f"SELECT d.doc_id, {cols} FROM documents d LEFT JOIN clean_spans c ON d.doc_id = c.doc_id "
                     "GROUP BY d.doc_id")


@register("e03_group_entities", _group_sql())
def e03_group_entities(spark, sf_dir):
    t = fx.tagged(spark, sf_dir).select(
        "doc_id", E.clean_entities(E.extract_entities("tokens", "ner_tags")).alias("ents")
    )
    cols = []
    for k in E.ENTITY_KINDS:
        g = E.group_entities("ents", k)
        cols += [F.array_join(g, " | ").alias(k.lower()), F.size(g).alias(f"n_{k.lower()}")]
    return normalise(t.select("doc_id", *cols))


@register(
    "e04_build_prompt",
    with_ctes(q.tagged_docs_cte(), q.entity_spans_cte(), q.doc_sentiment_cte())
    + "SELECT d.doc_id, 'Entidades: ' || coalesce((SELECT string_agg(sp.entity || ' (' || sp.tag || ')', '; ' "
    "ORDER BY sp.grp) FROM spans sp WHERE sp.doc_id = d.doc_id), '') || '. Sentimiento: ' || d.sentiment || "
    "'. Texto: ' || array_to_string(t.toks, ' ') AS input_text "
    "FROM doc_sentiment d JOIN tok_lists t ON d.doc_id = t.doc_id",
)
def e04_build_prompt(spark, sf_dir):
    a = fx.alerts_input(spark, sf_dir)
    return normalise(a.select("doc_id", E.build_prompt("entities", "sentiment", "sentence").alias("input_text")))


def _phrase_sql(salt):
    cols = ", ".join(
        f"{q.phrase_pick('doc_id', k, E.PHRASES[k], salt)} AS {k.lower()}_phrase"
        for k in E.ENTITY_KINDS
    )
    return f"SELECT doc_id, {cols} FROM documents"


@register("e05_alert_phrase", _phrase_sql(0))
def e05_alert_phrase(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return normalise(d.select("doc_id", *[E.alert_phrase(k, "doc_id", 0).alias(f"{k.lower()}_phrase") for k in E.ENTITY_KINDS]))


@register(
    "e06_build_alert",
    with_ctes(q.tagged_docs_cte(), q.doc_sentiment_cte(), q.entity_spans_cte(), q.clean_spans_cte(), q.alerts_cte((0,)))
    + "SELECT doc_id, alert_0 AS target_text FROM alerts",
)
def e06_build_alert(spark, sf_dir):
    a = fx.alerts_input(spark, sf_dir)
    return normalise(
        a.select("doc_id", E.build_alert("entities", "sentiment", "sentiment_score", "doc_id").alias("target_text"))
    )


@register(
    "e07_alert_pairs",
    with_ctes(q.tagged_docs_cte(), q.doc_sentiment_cte(), q.entity_spans_cte(), q.clean_spans_cte(), q.alerts_cte((0,)))
    + "SELECT a.doc_id, 'Entidades: ' || coalesce((SELECT string_agg(sp.entity || ' (' || sp.tag || ')', '; ' "
    "ORDER BY sp.grp) FROM spans sp WHERE sp.doc_id = a.doc_id), '') || '. Sentimiento: ' || a.sentiment || "
    "'. Texto: ' || array_to_string(t.toks, ' ') AS input_text, a.alert_0 AS target_text "
    "FROM alerts a JOIN tok_lists t ON a.doc_id = t.doc_id",
)
def e07_alert_pairs(spark, sf_dir):
    from tonalert.operators.alerts import alert_pairs

    return normalise(alert_pairs(fx.alerts_input(spark, sf_dir), key="doc_id").select("doc_id", "input_text", "target_text"))


@register(
    "p09_sentiment_label",
    "SELECT doc_id, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS label FROM labels",
)
def p09_sentiment_label(spark, sf_dir):
    lab = fx.table(spark, sf_dir, "labels")
    return normalise(lab.select("doc_id", E.sentiment_label("quality").alias("label")))


@register(
    "p10_decode_tags",
    with_ctes(q.tagged_docs_cte())
    + f", names AS (SELECT doc_id, string_agg({q.sql_map(E.BIO_LABELS)}[tag], ' ' ORDER BY pos) AS tag_names FROM tagged_docs GROUP BY doc_id) "
    "SELECT l.doc_id, coalesce(tag_names, '') AS tag_names, len(toks) AS n FROM tok_lists l LEFT JOIN names USING (doc_id)",
)
def p10_decode_tags(spark, sf_dir):
    t = fx.tagged(spark, sf_dir)
    names = A.decode_tags("ner_tags", list(E.BIO_LABELS.values()))
    return normalise(t.select("doc_id", F.array_join(names, " ").alias("tag_names"), F.size("ner_tags").alias("n")))


@register(
    "p11_bio_label",
    with_ctes(q.tagged_docs_cte())
    + f"SELECT doc_id, pos, coalesce({q.sql_map(E.BIO_LABELS)}[(tag * 7) % 11], 'O') AS label FROM tagged_docs",
)
def p11_bio_label(spark, sf_dir):
    # Codes 0-10 (by a rule over the F2 codes), so that unknown codes 9 and 10 occur.
    t = fx.tagged_docs(spark, sf_dir)
    return normalise(t.select("doc_id", "pos", E.bio_label(F.pmod(F.col("tag") * 7, F.lit(11))).alias("label")))


@register(
    "p13_confidence_word",
    with_ctes(q.doc_sentiment_cte())
    + f"SELECT doc_id, {q.confidence_word('sentiment_score')} AS word FROM doc_sentiment",
)
def p13_confidence_word(spark, sf_dir):
    d = fx.doc_sentiment(spark, sf_dir)
    return normalise(d.select("doc_id", E.confidence_word("sentiment_score").alias("word")))


@register(
    "a04_zip_shortest",
    with_ctes(q.tagged_docs_cte())
    + "SELECT t.doc_id, t.pos, t.tok, t.tag FROM tagged_docs t JOIN tok_lists l ON t.doc_id = l.doc_id "
    "WHERE t.pos < len(l.toks) - t.doc_id % 4",
)
def a04_zip_shortest(spark, sf_dir):
    # doc_id mod 4 tags are missing at the end, so the zip is decided by the shorter side.
    t = fx.tagged(spark, sf_dir)
    left = F.greatest(F.size("ner_tags") - F.pmod("doc_id", F.lit(4)), F.lit(0)).cast("int")
    short = F.slice("ner_tags", 1, left)
    z = A.zip_shortest("tokens", short)
    return normalise(
        t.select("doc_id", F.posexplode(z).alias("pos", "p")).select("doc_id", "pos", F.col("p.a").alias("tok"), F.col("p.b").alias("tag"))
    )

