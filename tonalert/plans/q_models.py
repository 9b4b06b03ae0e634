"""Queries for the model steps (M1, M3, M4, M8) and the gazetteer tagger."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.functions import entities as E
from tonalert.functions import text as TX
from tonalert.operators import models as MD
from tonalert.operators.alerts import BAD_WORDS, GOOD_WORDS, alert_pairs
from tonalert.operators.joins import checked_broadcast
from tonalert.operators.splits import split_exact
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.q_arrays import _vocab_cte, known_vocab
from tonalert.plans.registry import normalise, register, with_ctes
from tonalert.session import reliable_checkpoint, scratch_path


def lexicon_model():
    """A stand-in for a pretrained scorer (no weights are available offline): counts listed
    good/bad words among lower-cased space-separated words."""
    good, bad = set(GOOD_WORDS), set(BAD_WORDS)

    def model(texts):
        out = []
        for t in texts:
            ws = (t or "").lower().split(" ")
            pos = sum(w in good for w in ws)
            neg = sum(w in bad for w in ws)
            label = "positive" if pos > neg else "negative" if neg > pos else "neutral"
            out.append((label, (max(pos, neg) / (pos + neg)) if pos + neg else 0.5))
        return out

    return model


def _sentences(spark, sf_dir):
    return fx.tagged(spark, sf_dir).select("doc_id", TX.join_tokens("tokens").alias("sentence"))


@register(
    "m01_score_batches",
    with_ctes(q.tagged_docs_cte())
    + f", ws AS (SELECT doc_id, string_split(lower(array_to_string(toks, ' ')), ' ') AS w FROM tok_lists), "
    f"c AS (SELECT doc_id, len(list_filter(w, lambda x: list_contains({q.sql_list(GOOD_WORDS)}, x))) AS pos, "
    f"len(list_filter(w, lambda x: list_contains({q.sql_list(BAD_WORDS)}, x))) AS neg FROM ws) "
    "SELECT doc_id, CASE WHEN pos > neg THEN 'positive' WHEN neg > pos THEN 'negative' ELSE 'neutral' END AS sentiment, "
    "round(CASE WHEN pos + neg = 0 THEN 0.5 ELSE greatest(pos, neg) / (pos + neg) END, 6) AS sentiment_score FROM c",
)
def m01_score_batches(spark, sf_dir):
    fields = [T.StructField("sentiment", T.StringType()), T.StructField("sentiment_score", T.DoubleType())]
    s = MD.score_batches(_sentences(spark, sf_dir), lexicon_model, "sentence", fields, batch=100, keep=["doc_id"])
    return normalise(s.select("doc_id", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score")))


def brittle_model():
    """A stand-in for a scorer that some rows break: it raises on a batch with a sentence of a length divisible by nine."""
    def model(texts):
        if any(len(t) % 9 == 0 for t in texts):
            raise ValueError("length not supported")
        return [(len(t),) for t in texts]

    return model


@register(
    "m01_poison_rows",
    with_ctes(q.tagged_docs_cte())
    + ", s AS (SELECT doc_id, length(array_to_string(toks, ' ')) AS n FROM tok_lists) "
    "SELECT doc_id, CASE WHEN n % 9 <> 0 THEN n END AS size, CASE WHEN n % 9 = 0 THEN 'ValueError: length not supported' END AS error FROM s",
)
def m01_poison_rows(spark, sf_dir):
    """M1 with rows that the model fails on: they get an error, all others their result."""
    s = MD.score_batches(_sentences(spark, sf_dir), brittle_model, "sentence", [T.StructField("size", T.LongType())], batch=100, keep=["doc_id"], error="error")
    return normalise(s.select("doc_id", "size", "error"))


def _train_data(spark, sf_dir):
    """Labelled documents with their mean word vector and split, written once."""
    tw = split_exact(fx.tweets(spark, sf_dir), "doc_id", fx.TRAIN_FRACTION, fx.SPLIT_SEED)
    lab = fx.logits(spark, sf_dir).select("doc_id", F.col("y").alias("target"))
    rows = tw.join(checked_broadcast(lab, materialize=False), "doc_id").select("doc_id", "target", "split", TX.normalize_tweet("raw").alias("tokens"))
    return reliable_checkpoint(MD.with_features(rows, known_vocab(spark, sf_dir)))


def _model(data):
    return MD.train_sentiment(data.filter(F.col("split") == "train"), "target", max_iter=20)


_LABELLED = with_ctes(q.logits_cte(), q.splits_cte()) + "SELECT {} FROM logits l JOIN splits s ON l.doc_id = s.doc_id WHERE s.split = '{}'"
_EVALUATED = ("count(*) AS n, count(*) FILTER (y = 2) AS n_positive, CAST(1 AS BIGINT) AS accuracies_in_range, "
              "CAST(0 AS BIGINT) AS rows_without_class")


def _evaluated(model, rows):
    """Row and class counts, and whether what the model says lies where it must."""
    ev = MD.evaluate_sentiment(model, rows, "target")
    counts = MD.predict_sentiment(model, rows).agg(
        F.sum((F.col("target") == 2).cast("bigint")).alias("n_positive"),
        F.sum((~(F.col("pred_banded").isin(0, 1, 2) & F.col("p").between(0, 1))).cast("bigint")).alias("rows_without_class"))
    ok = (F.col("accuracy").between(0, 1) & F.col("accuracy3").between(0, 1)).cast("bigint")
    return normalise(ev.crossJoin(counts).select("n", "n_positive", ok.alias("accuracies_in_range"), "rows_without_class"))  # one row each


@register(
    "m03_features",
    with_ctes(q.tagged_docs_cte(), _vocab_cte())
    + ", w AS (SELECT doc_id, unnest(toks) AS word FROM tok_lists) "
    "SELECT w.doc_id, count(*) AS n_known, round(avg(CAST(e.embedding[1] AS DOUBLE)), 5) AS v0, "
    "round(avg(CAST(e.embedding[len(e.embedding)] AS DOUBLE)), 5) AS v_last "
    "FROM w JOIN vocab v USING (word) JOIN embeddings e ON e.vec_id = v.idx GROUP BY w.doc_id",
)
def m03_features(spark, sf_dir):
    """M3's input: the mean vector of each document's known words."""
    voc = known_vocab(spark, sf_dir)
    means = MD.doc_vectors(fx.tagged(spark, sf_dir), voc).select("doc_id", "n_known", vector_to_array("features").alias("v"))
    return normalise(means.select("doc_id", "n_known", F.round(F.get("v", F.lit(0)), 5).alias("v0"),
                                  F.round(F.element_at("v", -1), 5).alias("v_last")))


@register("m03_train_sentiment", _LABELLED.format(_EVALUATED, "train"))
def m03_train_sentiment(spark, sf_dir):
    data = _train_data(spark, sf_dir)
    return _evaluated(_model(data), data.filter(F.col("split") == "train"))


@register("m05_save_load", "SELECT l.doc_id, CAST(1 AS BIGINT) AS same FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def m05_save_load(spark, sf_dir):
    """M5: the trained pipeline saved to the shared folder and loaded back; every row is scored by
    both, ``same`` = 1 where the loaded model gives the same probability."""
    data = _train_data(spark, sf_dir)
    model = _model(data)
    path = scratch_path(spark, "sentiment-model")
    MD.save_model(model, path)
    both = MD.predict_sentiment(model, data).select("doc_id", F.col("p").alias("p0")).join(
        MD.predict_sentiment(MD.load_model(path), data).select("doc_id", "p"), "doc_id")
    return normalise(both.select("doc_id", (F.abs(F.col("p") - F.col("p0")) <= F.lit(1e-12)).cast("int").alias("same")))


@register("m04_evaluate_sentiment", _LABELLED.format(_EVALUATED, "test"))
def m04_evaluate_sentiment(spark, sf_dir):
    data = _train_data(spark, sf_dir)
    return _evaluated(_model(data), data.filter(F.col("split") == "test"))


@register(
    "m08_generate_alerts",
    with_ctes(q.tagged_docs_cte(), q.doc_sentiment_cte(), q.entity_spans_cte(), q.clean_spans_cte(), q.alerts_cte((0, 1)))
    + "SELECT a.doc_id, 'Entidades: ' || coalesce((SELECT string_agg(sp.entity || ' (' || sp.tag || ')', '; ' "
    "ORDER BY sp.grp) FROM spans sp WHERE sp.doc_id = a.doc_id), '') || '. Sentimiento: ' || a.sentiment || "
    "'. Texto: ' || array_to_string(t.toks, ' ') AS input_text, a.alert_1 AS prediction, a.alert_0 AS reference "
    "FROM alerts a JOIN tok_lists t ON a.doc_id = t.doc_id",
)
def m08_generate_alerts(spark, sf_dir):
    pairs = alert_pairs(fx.alerts_input(spark, sf_dir), key="doc_id")
    return normalise(MD.generate_alerts(pairs, key="doc_id").select("doc_id", "input_text", "prediction", "reference"))


@register(
    "e09_tag_tokens",
    with_ctes(q.tagged_docs_cte(), q.entity_spans_cte())
    + ", gaz AS (SELECT tok, min(kind) AS kind FROM (SELECT unnest(string_split(entity, ' ')) AS tok, tag AS kind FROM spans) "
    "WHERE tok <> '' GROUP BY tok), "
    "tp AS (SELECT doc_id, CAST(p - 1 AS BIGINT) AS pos, toks[p] AS tok, CASE WHEN p > 1 THEN toks[p - 1] END AS prev "
    "FROM (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS p FROM tok_lists)) "
    "SELECT tp.doc_id, tp.pos, tp.tok, CASE WHEN g.kind IS NULL THEN 'O' WHEN gp.kind = g.kind THEN 'I-' || g.kind "
    "ELSE 'B-' || g.kind END AS tag FROM tp LEFT JOIN gaz g ON tp.tok = g.tok LEFT JOIN gaz gp ON tp.prev = gp.tok",
)
def e09_tag_tokens(spark, sf_dir):
    t = fx.tagged(spark, sf_dir)
    spans = t.select(F.explode(E.extract_entities("tokens", "ner_tags")).alias("e")).select("e.entity", "e.tag")
    gaz = reliable_checkpoint(MD.gazetteer_from_spans(spans))  # computed once, then measured and joined
    return normalise(MD.tag_tokens(t.select("doc_id", "tokens"), gaz))
