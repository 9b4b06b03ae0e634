"""Queries for projections, predicates and label rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.functions import labels as L
from tonalert.functions import text as TX
from tonalert.operators import tables as tb
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.registry import normalise, register, with_ctes


@register("p01_keep", "SELECT doc_id, lang, source FROM documents")
def p01_keep(spark, sf_dir):
    return normalise(tb.keep(fx.table(spark, sf_dir, "documents"), ["doc_id", "lang", "source"]))


@register(
    "p02_with_derived",
    f"SELECT doc_id, upper(lang) AS lang_code, len({q.words('text')}) AS n_words, n_chars * 2 AS n_chars2 FROM documents",
)
def p02_with_derived(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    out = tb.with_derived(d, {
        "lang_code": F.upper("lang"),
        "n_words": F.size(TX.words("text")),
        "n_chars2": F.col("n_chars") * 2,
    })
    return normalise(out.select("doc_id", "lang_code", "n_words", "n_chars2"))


@register(
    "p03_fill_text",
    f"SELECT d.doc_id, coalesce(b.text, '') AS caption FROM documents d LEFT JOIN benchmark b "
    f"ON b.item_id = {q.CAPTION_KEY}",
)
def p03_fill_text(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").withColumn("item_id", fx.caption_key(spark, sf_dir))
    j = d.join(fx.captions(spark, sf_dir), "item_id", "left")
    return normalise(j.select("doc_id", tb.fill_text("caption").alias("caption")))


@register(
    "p04_has_suffix",
    "SELECT page_id, CAST(suffix(url, '.html') OR suffix(url, '.htm') AS BIGINT) AS is_page, "
    "CAST(suffix(lower(url), '/') AS BIGINT) AS is_dir FROM pages",
)
def p04_has_suffix(spark, sf_dir):
    p = fx.table(spark, sf_dir, "pages")
    return normalise(p.select(
        "page_id",
        tb.has_suffix("url", [".html", ".htm"]).cast("bigint").alias("is_page"),
        tb.has_suffix("url", ["/"], ignore_case=True).cast("bigint").alias("is_dir"),
    ))


@register(
    "p05_recode_target",
    "SELECT doc_id, CAST(CASE WHEN toxic * 4 = 4 THEN 2 ELSE toxic * 4 END AS BIGINT) AS target, "
    "CAST(CASE WHEN quality * 2 = 4 THEN 2 ELSE quality * 2 END AS BIGINT) AS target_kept FROM labels",
)
def p05_recode_target(spark, sf_dir):
    lab = fx.table(spark, sf_dir, "labels")
    return normalise(lab.select(
        "doc_id",
        L.recode_target(F.col("toxic") * 4).alias("target"),
        L.recode_target(F.col("quality") * 2).alias("target_kept"),
    ))


@register(
    "p06_loss_label",
    with_ctes(q.logits_cte()) + "SELECT doc_id, CASE WHEN y = 2 THEN 1.0 ELSE CAST(y AS DOUBLE) END AS y_loss FROM logits",
)
def p06_loss_label(spark, sf_dir):
    return normalise(fx.logits(spark, sf_dir).select("doc_id", L.loss_label("y").alias("y_loss")))


@register(
    "p07_sentiment_to_idx",
    with_ctes(q.doc_sentiment_cte())
    + "SELECT doc_id, CAST(CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN 0 WHEN 'neutral' THEN 2 END AS BIGINT) AS idx "
    "FROM doc_sentiment",
)
def p07_sentiment_to_idx(spark, sf_dir):
    return normalise(fx.doc_sentiment(spark, sf_dir).select("doc_id", L.sentiment_to_idx("sentiment").alias("idx")))


@register(
    "p08_sentiment_is_one",
    "SELECT doc_id, CAST(CASE WHEN quality = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_one, "
    "CAST(CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS BIGINT) AS toxic_one "
    "FROM labels",
)
def p08_sentiment_is_one(spark, sf_dir):
    lab = fx.table(spark, sf_dir, "labels")
    return normalise(lab.select("doc_id", L.sentiment_is_one("quality").alias("is_one"),
                                L.sentiment_is_one("toxic").alias("toxic_one")))


LABELS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("toxic", T.LongType()),
    T.StructField("quality", T.LongType()),
])


@register("p12_to_schema", "SELECT doc_id, CAST(toxic AS BIGINT) AS toxic, CAST(quality AS BIGINT) AS quality FROM labels")
def p12_to_schema(spark, sf_dir):
    return normalise(tb.to_schema(fx.table(spark, sf_dir, "labels"), LABELS_SCHEMA))


_P = "1.0 / (1.0 + exp(-x))"


@register("p14_sigmoid", with_ctes(q.logits_cte()) + f"SELECT doc_id, round({_P}, 6) AS p FROM logits")
def p14_sigmoid(spark, sf_dir):
    return normalise(fx.logits(spark, sf_dir).select("doc_id", F.round(L.sigmoid("x"), 6).alias("p")))


@register(
    "p15_class_binary",
    with_ctes(q.logits_cte()) + f"SELECT doc_id, CAST(CASE WHEN {_P} >= 0.5 THEN 2 ELSE 0 END AS BIGINT) AS pred FROM logits",
)
def p15_class_binary(spark, sf_dir):
    return normalise(fx.logits(spark, sf_dir).select("doc_id", L.class_binary(L.sigmoid("x")).alias("pred")))


@register(
    "p16_class_banded",
    with_ctes(q.logits_cte())
    + f"SELECT doc_id, CAST(CASE WHEN {_P} < 0.45 THEN 0 WHEN {_P} > 0.55 THEN 2 ELSE 1 END AS BIGINT) AS pred FROM logits",
)
def p16_class_banded(spark, sf_dir):
    return normalise(fx.logits(spark, sf_dir).select("doc_id", L.class_banded(L.sigmoid("x")).alias("pred")))


@register(
    "p17_class_round",
    with_ctes(q.logits_cte()) + f"SELECT doc_id, CAST(round_even({_P}, 0) AS BIGINT) AS pred FROM logits",
)
def p17_class_round(spark, sf_dir):
    return normalise(fx.logits(spark, sf_dir).select("doc_id", L.class_round(L.sigmoid("x")).alias("pred")))


@register(
    "p19_cast_label",
    with_ctes(q.logits_cte())
    + "SELECT doc_id, CAST(y AS DOUBLE) AS y_float, CAST(TRY_CAST(CAST(y AS VARCHAR) || 'x' AS INTEGER) AS BIGINT) AS bad_int, "
    "CAST(TRY_CAST(CAST(y AS VARCHAR) AS INTEGER) AS BIGINT) AS y_int FROM logits",
)
def p19_cast_label(spark, sf_dir):
    lg = fx.logits(spark, sf_dir)
    return normalise(lg.select(
        "doc_id",
        L.cast_label("y", "double").alias("y_float"),
        L.cast_label(F.concat(F.col("y").cast("string"), F.lit("x")), "int").alias("bad_int"),
        L.cast_label(F.col("y").cast("string"), "int").alias("y_int"),
    ))


@register("p20_peek", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def p20_peek(spark, sf_dir):
    return normalise(tb.peek(fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id", 5))
