"""Queries for metrics and scorer comparison (G1-G8, G10, G11, L8, M6, M9) and key joins
(J5-J7, E8)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tonalert.functions import labels as L
from tonalert.operators import joins as J
from tonalert.operators import metrics as M
from tonalert.operators.alerts import fuse_caption
from tonalert.operators.splits import split_exact
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.registry import normalise, register, with_ctes
from tonalert.session import scratch_path
from tonalert.streaming import streams as ST

_LG = with_ctes(q.logits_cte())
_P = "(1.0 / (1.0 + exp(-x)))"
_BIN = f"(CASE WHEN {_P} >= 0.5 THEN 2 ELSE 0 END)"
_BAND = f"(CASE WHEN {_P} < 0.45 THEN 0 WHEN {_P} > 0.55 THEN 2 ELSE 1 END)"
_LOSS = "(greatest(x, 0.0) - x * (CASE WHEN y = 2 THEN 1.0 ELSE CAST(y AS DOUBLE) END) + ln(1 + exp(-abs(x))))"


def _acc_sql(pred, label):
    return f"coalesce(avg(CASE WHEN {pred} = {label} THEN 1.0 ELSE 0.0 END), 0.0)"


@register("g01_accuracy", _LG + f"SELECT round({_acc_sql(_BIN, 'y')}, 6) AS accuracy FROM logits")
def g01_accuracy(spark, sf_dir):
    lg = fx.logits(spark, sf_dir)
    return normalise(lg.agg(F.round(M.accuracy(L.class_binary(L.sigmoid("x")), "y"), 6).alias("accuracy")))


@register("g02_accuracy3", _LG + f"SELECT round({_acc_sql(_BAND, 'y')}, 6) AS accuracy3 FROM logits")
def g02_accuracy3(spark, sf_dir):
    lg = fx.logits(spark, sf_dir)
    return normalise(lg.agg(F.round(M.accuracy3(L.sigmoid("x"), "y"), 6).alias("accuracy3")))


@register(
    "g03_agreement",
    _LG + f"SELECT round({_acc_sql(f'CAST(round_even({_P}, 0) AS INTEGER)', '(CASE WHEN y = 2 THEN 1 ELSE 0 END)')} * 100.0, 6) "
    "AS agreement FROM logits",
)
def g03_agreement(spark, sf_dir):
    lg = fx.logits(spark, sf_dir)
    lab = F.when(F.col("y") == 2, F.lit(1)).otherwise(F.lit(0))
    return normalise(lg.agg(F.round(M.agreement(L.sigmoid("x"), lab), 6).alias("agreement")))


@register("g04_log_loss", _LG + f"SELECT round(avg({_LOSS}), 6) AS log_loss FROM logits")
def g04_log_loss(spark, sf_dir):
    lg = fx.logits(spark, sf_dir)
    return normalise(lg.agg(F.round(M.log_loss("x", "y"), 6).alias("log_loss")))


@register("g05_max_chars", with_ctes(q.tweets_cte()) + "SELECT max(length(raw)) AS max_chars FROM tweets")
def g05_max_chars(spark, sf_dir):
    return normalise(fx.tweets(spark, sf_dir).agg(M.max_chars("raw").alias("max_chars")))


@register(
    "g06_n_rows",
    with_ctes(q.splits_cte()) + "SELECT (SELECT count(*) FROM documents) AS n_docs, (SELECT count(*) FROM labels) AS n_labels, "
    "(SELECT count(*) FROM splits WHERE split = 'train') AS n_train",
)
def g06_n_rows(spark, sf_dir):
    from tonalert.operators.splits import split_exact

    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    split = split_exact(docs, "doc_id", fx.TRAIN_FRACTION, fx.SPLIT_SEED)
    counts = (
        split.select(F.lit("n_docs").alias("metric"))
        .unionByName(fx.table(spark, sf_dir, "labels").select(F.lit("n_labels").alias("metric")))
        .unionByName(split.filter(F.col("split") == "train").select(F.lit("n_train").alias("metric")))
    )
    # One grouped count, pivoted to one row (names fixed up front, so no extra pass).
    names = ["n_docs", "n_labels", "n_train"]
    return normalise(counts.groupBy().pivot("metric", names).agg(M.n_rows()).select(*names))


def _rouge1_sql():
    rt = q.rouge_tokens
    return (
        with_ctes(q.alert_predictions_cte())
        + f", tp AS (SELECT doc_id, unnest({rt('prediction')}) AS tok FROM alert_predictions), "
        f"tr AS (SELECT doc_id, unnest({rt('reference')}) AS tok FROM alert_predictions), "
        "cp AS (SELECT doc_id, tok, count(*) AS c FROM tp GROUP BY doc_id, tok), "
        "cr AS (SELECT doc_id, tok, count(*) AS c FROM tr GROUP BY doc_id, tok), "
        "ov AS (SELECT cp.doc_id, CAST(sum(least(cp.c, cr.c)) AS DOUBLE) AS o FROM cp JOIN cr ON cp.doc_id = cr.doc_id "
        "AND cp.tok = cr.tok GROUP BY cp.doc_id), "
        f"lens AS (SELECT doc_id, CAST(len({rt('prediction')}) AS DOUBLE) AS np, CAST(len({rt('reference')}) AS DOUBLE) AS nr "
        "FROM alert_predictions) "
    )


@register(
    "g07_rouge1",
    _rouge1_sql() + "SELECT l.doc_id, round(CASE WHEN l.np = 0 OR l.nr = 0 OR coalesce(ov.o, 0) = 0 THEN 0.0 ELSE "
    "2 * (ov.o / l.np) * (ov.o / l.nr) / ((ov.o / l.np) + (ov.o / l.nr)) END, 6) AS rouge1 "
    "FROM lens l LEFT JOIN ov ON l.doc_id = ov.doc_id",
)
def g07_rouge1(spark, sf_dir):
    r = M.rouge1(fx.alert_predictions(spark, sf_dir), "doc_id", "prediction", "reference")
    return normalise(r.select("doc_id", F.round("rouge1", 6).alias("rouge1")))


# Turns of a conversation against the next turn: pairs of whole texts that differ in words and order.
_TURNS = (
    "turns AS (SELECT conv_id, turn, coalesce(text, '') AS prediction, coalesce(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS reference, "
    "CASE WHEN conv_id % 10 < 8 THEN 'train' WHEN conv_id % 10 = 8 THEN 'val' ELSE 'test' END AS split FROM conversations), "
    f"tk AS (SELECT conv_id, turn, split, {q.rouge_tokens('prediction')} AS a, {q.rouge_tokens('reference')} AS b FROM turns), "
    # Longest common subsequence row by row: the state is the last row of the table.
    "lcs AS (SELECT *, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE list_last(list_reduce("
    "list_prepend(list_transform(range(len(b) + 1), lambda x: 0::BIGINT), list_transform(a, lambda t: list_prepend(0::BIGINT, list_transform(b, lambda u: CASE WHEN u = t THEN 1::BIGINT ELSE 0::BIGINT END)))), "
    "lambda d, m: list_reduce(list_prepend([0::BIGINT], list_transform(range(2, len(m) + 1), "
    "lambda j: CASE WHEN m[j] = 1 THEN [1, d[j - 1] + 1, j] ELSE [0, d[j], j] END)), "
    "lambda row, x: list_append(row, greatest(x[2], row[len(row)]))))) END AS n FROM tk), "
    "bag AS (SELECT conv_id, turn, CAST(sum(least(x.c, y.c)) AS DOUBLE) AS o FROM "
    "(SELECT conv_id, turn, w, count(*) AS c FROM (SELECT conv_id, turn, unnest(a) AS w FROM tk) GROUP BY ALL) x JOIN "
    "(SELECT conv_id, turn, w, count(*) AS c FROM (SELECT conv_id, turn, unnest(b) AS w FROM tk) GROUP BY ALL) y USING (conv_id, turn, w) GROUP BY conv_id, turn), "
    "scores AS (SELECT conv_id, turn, split, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE 2 * (n::DOUBLE / len(a)) * (n::DOUBLE / len(b)) / (n::DOUBLE / len(a) + n::DOUBLE / len(b)) END AS rl, "
    "CASE WHEN coalesce(o, 0) = 0 THEN 0.0::DOUBLE ELSE 2 * (o / len(a)) * (o / len(b)) / (o / len(a) + o / len(b)) END AS r1 "
    "FROM lcs LEFT JOIN bag USING (conv_id, turn)) "
)


def _turns(spark, sf_dir):
    following = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    part = F.pmod("conv_id", F.lit(10))
    split = F.when(part < 8, F.lit("train")).when(part == 8, F.lit("val")).otherwise(F.lit("test"))
    return fx.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.coalesce("text", F.lit("")).alias("prediction"), F.coalesce(following, F.lit("")).alias("reference"), split.alias("split"))


@register("g08_rougeL")  # over whole documents: LCS in SQL is cubic there; its rows are held against Python, g08_rougeL_turns against SQL
def g08_rougeL(spark, sf_dir):
    r = M.rougeL(fx.alert_predictions(spark, sf_dir), "doc_id", "prediction", "reference")
    return normalise(r.select("doc_id", F.round("rougeL", 6).alias("rougeL")))


@register("g08_rougeL_turns", "WITH " + _TURNS + "SELECT conv_id, CAST(turn AS BIGINT) AS turn, round(rl, 6) AS rougeL FROM scores")
def g08_rougeL_turns(spark, sf_dir):
    r = M.rouge_scores(_turns(spark, sf_dir), ["conv_id", "turn"], "prediction", "reference")
    return normalise(r.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.round("rougeL", 6).alias("rougeL")))


@register("g09_stem_rouge")  # Porter stems in Arrow batches; checked row by row against Python in tests
def g09_stem_rouge(spark, sf_dir):
    r = M.rouge_scores(fx.alert_predictions(spark, sf_dir), "doc_id", "prediction", "reference", stem=M.porter_stem)
    return normalise(r.select("doc_id", F.round("rouge1", 6).alias("rouge1"), F.round("rougeL", 6).alias("rougeL")))


@register("m09_evaluate_alerts")  # over whole documents (see g08); m09_evaluate_turns has the SQL
def m09_evaluate_alerts(spark, sf_dir):
    """M9 over the alerts of whole documents, per split."""
    rows = split_exact(fx.alert_predictions(spark, sf_dir), "doc_id", fx.TRAIN_FRACTION, fx.SPLIT_SEED)
    return normalise(M.evaluate_alerts(rows, split="split"))


@register(
    "m09_evaluate_turns",
    "WITH " + _TURNS + "SELECT split, round(avg(r1) * 100 + 1e-9, 2) AS rouge1, round(avg(rl) * 100 + 1e-9, 2) AS rougeL, count(*) AS n FROM scores GROUP BY split",
)
def m09_evaluate_turns(spark, sf_dir):
    """M9 per split, without stems (SQL has no stemmer; g09 and the tests cover them)."""
    return normalise(M.evaluate_alerts(_turns(spark, sf_dir), split="split"))


REPLICATES = 100
_DRAWN = " + ".join(f"(u >= {x})::INT" for x in M.POISSON_STEPS)


@register(
    "m09_alert_intervals",
    "WITH " + _TURNS + ", draws AS (SELECT split, r1, rl, b, ('0x' || substr(md5(conv_id::VARCHAR || '/' || turn::VARCHAR || ':' || ((b - 1) // 4)::VARCHAR), "
    f"((b - 1) % 4) * 8 + 1, 8))::BIGINT AS u FROM scores, range(1, {REPLICATES + 1}) r(b)), "
    f"weighted AS (SELECT split, b, r1, rl, {_DRAWN} AS w FROM draws), "
    "means AS (SELECT split, b, sum(w * r1) / sum(w) AS m1, sum(w * rl) / sum(w) AS ml FROM weighted WHERE w > 0 GROUP BY split, b), "
    "ranked AS (SELECT split, list_sort(list(m1)) AS l1, list_sort(list(ml)) AS ll FROM means GROUP BY split), "
    "whole AS (SELECT split, count(*) AS n, avg(r1) AS m1, avg(rl) AS ml FROM scores GROUP BY split) "
    "SELECT split, n, " + ", ".join(
        f"round(100 * {l}[greatest(ceil(len({l}) * 0.025 - 1e-9), 1)::INT] + 1e-9, 2) AS {v}_low, round(100 * {m} + 1e-9, 2) AS {v}_mid, "
        f"round(100 * {l}[greatest(ceil(len({l}) * 0.975 - 1e-9), 1)::INT] + 1e-9, 2) AS {v}_high" for l, m, v in (("l1", "m1", "rouge1"), ("ll", "ml", "rougeL")))
    + " FROM ranked JOIN whole USING (split)",
)
def m09_alert_intervals(spark, sf_dir):
    """M9 with bootstrap intervals per split."""
    return normalise(M.alert_intervals(_turns(spark, sf_dir), ["conv_id", "turn"], split="split", replicates=REPLICATES))


_STEPS = (
    f"m AS (SELECT doc_id % 10 AS step, {_acc_sql(_BIN, 'y')} AS accuracy, avg({_LOSS}) AS loss, count(*) AS n "
    "FROM logits GROUP BY doc_id % 10)"
)


def _metrics(spark, sf_dir):
    lg = fx.logits(spark, sf_dir).withColumn("step", F.pmod("doc_id", F.lit(10)))
    return M.log_metrics(lg, "step", "x", "y")


@register(
    "g10_log_metrics",
    _LG + f", {_STEPS} SELECT step, round(accuracy, 6) AS accuracy, round(loss, 6) AS loss, n FROM m",
)
def g10_log_metrics(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    return normalise(m.select("step", F.round("accuracy", 6).alias("accuracy"), F.round("loss", 6).alias("loss"), "n"))


@register(
    "g11_best_step",
    _LG + f", {_STEPS} SELECT step AS best_step, round(loss, 6) AS best_loss FROM m ORDER BY loss, step LIMIT 1",
)
def g11_best_step(spark, sf_dir):
    b = M.best_step(_metrics(spark, sf_dir))
    return normalise(b.select("best_step", F.round("best_loss", 6).alias("best_loss")))


@register("l08_by_epoch", _LG + f", {_STEPS} SELECT step, n FROM m ORDER BY step")
def l08_by_epoch(spark, sf_dir):
    from tonalert.operators.splits import by_key

    return normalise(by_key(_metrics(spark, sf_dir).select("step", "n"), "step"))


@register(
    "m06_compare_scorers",
    with_ctes(q.logits_cte(), q.doc_sentiment_cte())
    + f"SELECT l.doc_id, d.sentiment, CAST({_BAND} AS BIGINT) AS predicted_sentiment, "
    f"CAST(CASE WHEN d.sentiment IS NULL THEN NULL WHEN {_BAND} = (CASE d.sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END) THEN 1 ELSE 0 END "
    "AS BIGINT) AS agree "
    "FROM logits l LEFT JOIN doc_sentiment d ON l.doc_id = d.doc_id",
)
def m06_compare_scorers(spark, sf_dir):
    from tonalert.operators.models import compare_scorers

    c = compare_scorers(fx.logits(spark, sf_dir), fx.doc_sentiment(spark, sf_dir), key="doc_id", logit="x")
    return normalise(c.select("doc_id", "sentiment", "predicted_sentiment", "agree"))


@register(
    "j05_attach_predictions",
    _LG + f"SELECT d.doc_id, p.pred FROM documents d LEFT JOIN (SELECT doc_id, CAST({_BIN} AS BIGINT) AS pred FROM logits) p "
    "ON d.doc_id = p.doc_id",
)
def j05_attach_predictions(spark, sf_dir):
    preds = fx.logits(spark, sf_dir).select("doc_id", L.class_binary(L.sigmoid("x")).alias("pred"))
    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    return normalise(J.attach_predictions(docs, preds, "doc_id"))


@register(
    "j06_pair_labels",
    _LG + f"SELECT doc_id, CAST({_BIN} AS BIGINT) AS pred, y AS label, CAST(CASE WHEN {_BIN} = y THEN 1 ELSE 0 END AS BIGINT) "
    "AS correct FROM logits",
)
def j06_pair_labels(spark, sf_dir):
    lg = fx.logits(spark, sf_dir)
    preds = lg.select("doc_id", L.class_binary(L.sigmoid("x")).alias("pred"))
    j = J.attach_predictions(lg.select("doc_id", F.col("y").alias("label")), preds, "doc_id")
    return normalise(j.select("doc_id", "pred", "label", (F.col("pred") == F.col("label")).cast("int").alias("correct")))


_FUSE_SQL = (
    f"SELECT d.doc_id, b.text AS caption, concat_ws(' ', d.text, b.text) AS fused FROM documents d "
    f"LEFT JOIN benchmark b ON b.item_id = {q.CAPTION_KEY}"
)


def _fused(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "item_id", fx.caption_key(spark, sf_dir))
    return fuse_caption(d, fx.captions(spark, sf_dir), "item_id")


@register("e08_fuse_caption", _FUSE_SQL)
def e08_fuse_caption(spark, sf_dir):
    return normalise(_fused(spark, sf_dir).select("doc_id", "caption", "fused"))


@register(
    "j07_join_captions",
    f"SELECT d.doc_id, b.item_id, b.text AS caption FROM documents d LEFT JOIN benchmark b ON b.item_id = {q.CAPTION_KEY}",
)
def j07_join_captions(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").select("doc_id", fx.caption_key(spark, sf_dir).alias("key"))
    c = fx.captions(spark, sf_dir)
    j = d.join(c, d["key"] == c["item_id"], "left")
    return normalise(j.select("doc_id", "item_id", "caption"))


@register(
    "g10_log_stream",
    _LG + f", {_STEPS} SELECT step, round(accuracy, 6) AS accuracy, round(loss, 6) AS loss, n FROM m",
)
def g10_log_stream(spark, sf_dir):
    """G10 written while rows stream in: the labelled rows as files, a few at a time, sums per micro-batch, one log."""
    folder = scratch_path(spark, "metric-stream")
    rows = fx.logits(spark, sf_dir).select(F.pmod("doc_id", F.lit(10)).alias("step"), "x", "y")
    rows.repartition(4).write.parquet(f"{folder}/rows")
    stream = ST.read_stream(spark, f"{folder}/rows", rows.schema, max_files=2)
    ST.log_metrics_stream(stream, f"{folder}/log", f"{folder}/checkpoint", "step", "x", "y")
    m = ST.metric_log(spark, f"{folder}/log", "step")
    return normalise(m.select("step", F.round("accuracy", 6).alias("accuracy"), F.round("loss", 6).alias("loss"), "n"))
