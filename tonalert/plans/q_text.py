"""Queries for the text rules (T1-T16) and the lexicon scorer (M2), over F1 ``tweets``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.functions import text as T
from tonalert.operators.alerts import BAD_WORDS, GOOD_WORDS, lexicon_sentiment
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.registry import normalise, register, with_ctes

_TW = with_ctes(q.tweets_cte())


def _one(name, fn_spark, fn_sql):
    @register(name, _TW + f"SELECT doc_id, {fn_sql('raw')} AS out FROM tweets")
    def run(spark, sf_dir):
        return normalise(fx.tweets(spark, sf_dir).select("doc_id", fn_spark("raw").alias("out")))

    run.__name__ = name
    return run


_one("t01_lower_text", T.lower_text, q.lower_text)
_one("t02_mask_mentions", T.mask_mentions, q.mask_mentions)
_one("t03_mask_urls", T.mask_urls, q.mask_urls)
_one("t04_mask_hashtags", T.mask_hashtags, q.mask_hashtags)
_one("t05_expand_words", T.expand_words, q.expand_words)
_one("t07_tag_emotions", T.tag_emotions, q.tag_emotions)
_one("t08_strip_marks", T.strip_marks, q.strip_marks)
_one("t09_space_marks", T.space_marks, q.space_marks)
_one("t10_mask_emoji", T.mask_emoji, q.mask_emoji)
_one("t11_collapse_space", T.collapse_space, q.collapse_space)
_one("t15_clean_text", T.clean_text, q.clean_text)


@register(
    "t06_split_possessive",
    _TW + f"SELECT doc_id, array_to_string(list_transform({q.words('raw')}, lambda w: {q.split_possessive('w')}), ' ') "
    "AS out FROM tweets",
)
def t06_split_possessive(spark, sf_dir):
    tw = fx.tweets(spark, sf_dir)
    return normalise(tw.select("doc_id", F.array_join(F.transform(T.words("raw"), T.split_possessive), " ").alias("out")))


@register(
    "t12_tokens",
    _TW + f"SELECT doc_id, len(tk) AS n_tokens, array_to_string(tk, ' ') AS out "
    f"FROM (SELECT doc_id, {q.words('raw')} AS tk FROM tweets)",
)
def t12_tokens(spark, sf_dir):
    tw = fx.tweets(spark, sf_dir).select("doc_id", T.tokens("raw").alias("tk"))
    return normalise(tw.select("doc_id", F.size("tk").alias("n_tokens"), F.array_join("tk", " ").alias("out")))


# T13 in SQL walks characters; a newline is never part of a run (the regex '.' stops there).
def _squeeze_sql(chars):
    return q.squeeze_chars(chars).replace("THEN '' ELSE c END", "AND c <> chr(10) THEN '' ELSE c END")


@register(
    "t13_squeeze_runs",
    _TW + f"SELECT doc_id, {_squeeze_sql('ch')} AS out FROM (SELECT doc_id, string_split(raw, '') AS ch FROM tweets)",
)
def t13_squeeze_runs(spark, sf_dir):
    return normalise(fx.tweets(spark, sf_dir).select("doc_id", T.squeeze_runs("raw").alias("out")))


@register(
    "t14_join_tokens",
    _TW + f"SELECT doc_id, array_to_string({q.words('raw')}, ' ') AS out FROM tweets",
)
def t14_join_tokens(spark, sf_dir):
    return normalise(fx.tweets(spark, sf_dir).select("doc_id", T.join_tokens(T.tokens("raw")).alias("out")))


_NORM_SQL = (
    _TW + f", pre AS (SELECT doc_id, string_split({q.pre_squeeze('raw')}, '') AS ch FROM tweets), "
    f"normed AS (SELECT doc_id, list_filter(string_split({_squeeze_sql('ch')}, ' '), lambda w: w <> '') AS tk FROM pre) "
)


@register(
    "t16_normalize_tweet",
    _NORM_SQL + "SELECT doc_id, len(tk) AS n_tokens, array_to_string(tk, ' ') AS out FROM normed",
)
def t16_normalize_tweet(spark, sf_dir):
    tw = fx.tweets(spark, sf_dir).select("doc_id", T.normalize_tweet("raw").alias("tk"))
    return normalise(tw.select("doc_id", F.size("tk").alias("n_tokens"), F.array_join("tk", " ").alias("out")))


def _m2_sql():
    good = q.sql_list(GOOD_WORDS + ["<good"])
    bad = q.sql_list(BAD_WORDS + ["<bad"])
    return (
        _NORM_SQL + f", counted AS (SELECT doc_id, len(list_filter(tk, lambda w: list_contains({good}, w))) AS pos, "
        f"len(list_filter(tk, lambda w: list_contains({bad}, w))) AS neg FROM normed) "
        "SELECT doc_id, CASE WHEN pos > neg THEN 'positive' WHEN neg > pos THEN 'negative' ELSE 'neutral' END AS label, "
        "round(CASE WHEN pos + neg = 0 THEN 0.5 ELSE greatest(pos, neg) / (pos + neg) END, 6) AS score, "
        "pos, neg FROM counted"
    )


@register("m02_lexicon_sentiment", _m2_sql())
def m02_lexicon_sentiment(spark, sf_dir):
    tw = fx.tweets(spark, sf_dir).select("doc_id", lexicon_sentiment(T.normalize_tweet("raw")).alias("s"))
    return normalise(tw.select("doc_id", "s.label", F.round("s.score", 6).alias("score"), "s.pos", "s.neg"))
