"""Queries for array parsing/shaping and the vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.constants import IGNORE_INDEX, MAX_INPUT_LEN
from tonalert.functions import arrays as A
from tonalert.functions import entities as E
from tonalert.functions import text as TX
from tonalert.operators import vocab as V
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.registry import normalise, register, with_ctes
from tonalert.session import reliable_checkpoint, scratch_path
from tonalert.sources.io import read_vocab_or_fit

BATCH = 64

# Legacy text lists, as the original CSV files held them: "['a', 'b']" and "[1 2 3]".
_QUOTED_SQL = "'[' || array_to_string(list_transform(toks, lambda t: '''' || t || ''''), ', ') || ']'"
_INTS_SQL = ("'[' || array_to_string(list_transform(toks, lambda t, i: CAST(((doc_id * 5 + i - 1) % 17) AS VARCHAR)), ' ') "
             "|| CASE WHEN doc_id % 7 = 0 THEN ' x' ELSE '' END || ']'")


def _legacy(spark, sf_dir):
    t = fx.tagged(spark, sf_dir)
    quoted = F.concat(F.lit("["), F.array_join(F.transform("tokens", lambda w: F.concat(F.lit("'"), w, F.lit("'"))), ", "), F.lit("]"))
    codes = F.transform("tokens", lambda w, i: F.pmod(F.col("doc_id") * 5 + i, F.lit(17)).cast("string"))
    ints = F.concat(F.lit("["), F.array_join(codes, " "),
                    F.when(F.pmod("doc_id", F.lit(7)) == 0, F.lit(" x")).otherwise(F.lit("")), F.lit("]"))
    return t.select("doc_id", quoted.alias("quoted"), ints.alias("ints"))


_LEG = with_ctes(q.tagged_docs_cte())


@register(
    "a01_parse_quoted_tokens",
    _LEG + f"SELECT doc_id, len(items) AS n_items, array_to_string(items, '|') AS items FROM "
    f"(SELECT doc_id, regexp_extract_all({_QUOTED_SQL}, '''(.*?)''', 1) AS items FROM tok_lists)",
)
def a01_parse_quoted_tokens(spark, sf_dir):
    t = _legacy(spark, sf_dir).select("doc_id", A.parse_quoted_tokens("quoted").alias("items"))
    return normalise(t.select("doc_id", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items")))


@register(
    "a02_parse_int_list",
    _LEG + f", raw AS (SELECT doc_id, list_filter(regexp_split_to_array(trim({_INTS_SQL}, '[]'), {q.s(q.WS + '+')}), "
    "lambda w: w <> '') AS items FROM tok_lists), "
    "parsed AS (SELECT doc_id, CASE WHEN len(list_filter(items, lambda x: TRY_CAST(x AS INTEGER) IS NULL)) > 0 "
    "THEN [] ELSE list_transform(items, lambda x: TRY_CAST(x AS INTEGER)) END AS v FROM raw) "
    "SELECT doc_id, len(v) AS n, array_to_string(v, ' ') AS ints FROM parsed",
)
def a02_parse_int_list(spark, sf_dir):
    t = _legacy(spark, sf_dir).select("doc_id", A.parse_int_list("ints").alias("v"))
    return normalise(t.select("doc_id", F.size("v").alias("n"), F.array_join("v", " ").alias("ints")))


@register(
    "a03_build_sentence",
    _LEG + f"SELECT doc_id, array_to_string(regexp_extract_all({_QUOTED_SQL}, '''(.*?)''', 1), ' ') AS sentence FROM tok_lists",
)
def a03_build_sentence(spark, sf_dir):
    return normalise(_legacy(spark, sf_dir).select("doc_id", A.build_sentence("quoted").alias("sentence")))


@register("a07_n_chars", with_ctes(q.tweets_cte()) + "SELECT doc_id, length(raw) AS n FROM tweets")
def a07_n_chars(spark, sf_dir):
    return normalise(fx.tweets(spark, sf_dir).select("doc_id", A.n_chars("raw").alias("n")))


@register("k06_array_text", with_ctes(q.tagged_docs_cte()) + "SELECT doc_id, CAST(to_json(toks) AS VARCHAR) AS js FROM tok_lists")
def k06_array_text(spark, sf_dir):
    return normalise(fx.tagged(spark, sf_dir).select("doc_id", A.array_text("tokens").alias("js")))


# ---------------------------------------------------------------- vocabulary ------------------

def vocab(spark, sf_dir):
    """Every word of the corpus, numbered."""
    return V.build_vocab(fx.table(spark, sf_dir, "documents"))


def known_vocab(spark, sf_dir):
    """The words that have a row in ``embeddings``, with their vector; written once and read again. Only as many words
    are numbered as the largest number of a row asks for."""
    rows = fx.table(spark, sf_dir, "embeddings")
    last = rows.agg(F.max("vec_id").alias("n")).first()["n"]
    words = V.top_vocab(fx.table(spark, sf_dir, "documents"), 0 if last is None else last + 1)
    return reliable_checkpoint(V.attach_vectors(words, rows, known_only=True))


def _vocab_cte():
    return (
        "all_words AS (SELECT word, CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS BIGINT) AS idx, cnt FROM "
        f"(SELECT word, count(*) AS cnt FROM (SELECT unnest({q.words('coalesce(text, chr(32))')}) AS word FROM documents) GROUP BY word)), "
        "vocab AS (SELECT word, idx, cnt FROM all_words WHERE idx IN (SELECT vec_id FROM embeddings))"
    )


def _known_cte():
    return (
        "tok_pos AS (SELECT doc_id, p, toks[p] AS word FROM (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS p "
        "FROM tok_lists)), "
        "known AS (SELECT l.doc_id, coalesce(list(v.idx ORDER BY t.p) FILTER (WHERE v.idx IS NOT NULL), []) AS ids "
        "FROM tok_lists l LEFT JOIN tok_pos t ON l.doc_id = t.doc_id LEFT JOIN vocab v ON t.word = v.word "
        "GROUP BY l.doc_id)"
    )


_VOC = with_ctes(q.tagged_docs_cte(), _vocab_cte(), _known_cte())


@register("f05_vocab", with_ctes(_vocab_cte()) + "SELECT word, idx, cnt FROM all_words")
def f05_vocab(spark, sf_dir):
    return normalise(vocab(spark, sf_dir))


@register(
    "j03_words_to_idx",
    _VOC + "SELECT doc_id, len(ids2) AS n, array_to_string(ids2, ' ') AS ids FROM "
    "(SELECT doc_id, CASE WHEN len(ids) = 0 THEN [0] ELSE ids END AS ids2 FROM known)",
)
def j03_words_to_idx(spark, sf_dir):
    j = V.words_to_idx(fx.tagged(spark, sf_dir), known_vocab(spark, sf_dir))
    return normalise(j.select("doc_id", F.size("ids").alias("n"), F.array_join("ids", " ").alias("ids")))


@register(
    "j04_idx_to_vector",
    _VOC + ", emb AS (SELECT vec_id AS idx, embedding FROM embeddings) "
    "SELECT k.doc_id, CAST(p - 1 AS BIGINT) AS pos, k.ids[p] AS idx, round(CAST(e.embedding[1] AS DOUBLE), 6) AS v0, "
    "round(CAST(list_sum(e.embedding) AS DOUBLE), 4) AS vsum, len(e.embedding) AS dim "
    "FROM (SELECT doc_id, ids, unnest(range(1, len(ids) + 1)) AS p FROM (SELECT doc_id, CASE WHEN len(ids) = 0 THEN [0] ELSE ids END AS ids "
    "FROM known)) k "
    "LEFT JOIN vocab v ON k.ids[p] = v.idx LEFT JOIN emb e ON v.idx = e.idx",
)
def j04_idx_to_vector(spark, sf_dir):
    voc = known_vocab(spark, sf_dir)
    ids = V.words_to_idx(fx.tagged(spark, sf_dir), voc)
    vsum = F.aggregate("vector", F.lit(0.0).cast("float"), lambda a, x: a + x)  # once per word
    out = V.idx_to_vector(ids, reliable_checkpoint(voc.withColumn("vsum", vsum)), carry=("vsum",))
    return normalise(out.select(
        "doc_id", "pos", "idx",
        F.round(F.get("vector", 0).cast("double"), 6).alias("v0"),
        F.round(F.col("vsum").cast("double"), 4).alias("vsum"),
        F.size("vector").alias("dim"),
    ))


@register(
    "a05_pad_sequences",
    _VOC + f", b AS (SELECT doc_id, doc_id // {BATCH} AS batch, ids, max(len(ids)) OVER (PARTITION BY doc_id // {BATCH}) AS L FROM known) "
    "SELECT doc_id, batch, greatest(len(ids), 1) AS length, len(ids || list_transform(range(L - len(ids)), lambda x: 0)) AS width, "
    "array_to_string(ids || list_transform(range(L - len(ids)), lambda x: 0), ' ') AS padded FROM b",
)
def a05_pad_sequences(spark, sf_dir):
    ids = V.known_indices(fx.tagged(spark, sf_dir), known_vocab(spark, sf_dir))
    ids = ids.withColumn("batch", F.floor(F.col("doc_id") / BATCH))
    p = V.pad_sequences(ids)
    return normalise(p.select("doc_id", "batch", "length", F.size("padded").alias("width"),
                              F.array_join("padded", " ").alias("padded")))


_FIX_SQL = f"(ids[1:{MAX_INPUT_LEN}] || list_transform(range({MAX_INPUT_LEN} - len(ids[1:{MAX_INPUT_LEN}])), lambda x: {{pad}}))"


_TARGETS = (
    with_ctes(q.tagged_docs_cte(), q.doc_sentiment_cte(), q.entity_spans_cte(), q.clean_spans_cte(), q.alerts_cte((0,)), _vocab_cte())
    + f", t_lists AS (SELECT doc_id, {q.words('alert_0')} AS toks FROM alerts), "
    + "both_lists AS (SELECT doc_id, 'input' AS side, toks FROM tok_lists UNION ALL SELECT doc_id, 'target' AS side, toks FROM t_lists), "
    "tok_pos AS (SELECT doc_id, side, p, toks[p] AS word FROM (SELECT doc_id, side, toks, unnest(range(1, len(toks) + 1)) AS p FROM both_lists)), "
    "found AS (SELECT l.doc_id, l.side, coalesce(list(v.idx ORDER BY t.p) FILTER (WHERE v.idx IS NOT NULL), []) AS ids "
    "FROM both_lists l LEFT JOIN tok_pos t ON l.doc_id = t.doc_id AND l.side = t.side LEFT JOIN vocab v ON t.word = v.word GROUP BY l.doc_id, l.side), "
    "known AS (SELECT i.doc_id, i.ids, t.ids AS tids FROM found i JOIN found t ON i.doc_id = t.doc_id AND i.side = 'input' AND t.side = 'target') "
)


def _model_rows(spark, sf_dir):
    """Word indices of the input text and of the target text (the alert) of every document."""
    voc = known_vocab(spark, sf_dir)
    rows = fx.alerts_input(spark, sf_dir).select(
        "doc_id", F.split("sentence", " ").alias("tokens"),
        TX.words(E.build_alert("entities", "sentiment", "sentiment_score", "doc_id")).alias("target"))
    rows = reliable_checkpoint(rows)
    target = V.known_indices(rows, voc, toks="target").withColumnRenamed("ids", "tids")
    return V.known_indices(rows, voc).join(target, "doc_id")


_LABELS_SQL = _FIX_SQL.replace("ids", "tids")


@register(
    "a06_fix_length",
    _TARGETS + f"SELECT doc_id, array_to_string({_FIX_SQL.format(pad=0)}, ' ') AS input_ids, "
    f"array_to_string(list_transform(range({MAX_INPUT_LEN}), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END), ' ') "
    f"AS attention_mask, array_to_string({_LABELS_SQL.format(pad=IGNORE_INDEX)}, ' ') AS labels FROM known",
)
def a06_fix_length(spark, sf_dir):
    return normalise(_model_rows(spark, sf_dir).select(
        "doc_id",
        F.array_join(A.fix_length("ids", MAX_INPUT_LEN, 0), " ").alias("input_ids"),
        F.array_join(A.attention_mask("ids", MAX_INPUT_LEN), " ").alias("attention_mask"),
        F.array_join(A.fix_length("tids", MAX_INPUT_LEN, IGNORE_INDEX), " ").alias("labels"),
    ))


@register(
    "p18_unmask_labels",
    _TARGETS + f"SELECT doc_id, array_to_string({_LABELS_SQL.format(pad=IGNORE_INDEX)}, ' ') AS labels, "
    f"array_to_string(list_transform({_LABELS_SQL.format(pad=IGNORE_INDEX)}, lambda x: CASE WHEN x = {IGNORE_INDEX} THEN 0 ELSE x END), ' ') "
    "AS unmasked FROM known",
)
def p18_unmask_labels(spark, sf_dir):
    lab = _model_rows(spark, sf_dir).select("doc_id", A.fix_length("tids", MAX_INPUT_LEN, IGNORE_INDEX).alias("labels"))
    return normalise(lab.select(
        "doc_id",
        F.array_join("labels", " ").alias("labels"),
        F.array_join(A.unmask_labels("labels", 0), " ").alias("unmasked"),
    ))


@register(
    "l07_longest_first",
    _VOC + f", rk AS (SELECT doc_id, (row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{fx.SPLIT_SEED}'), "
    "doc_id) - 1) "
    f"// {BATCH} AS batch FROM known) "
    "SELECT k.doc_id, r.batch, len(k.ids) AS length, "
    "row_number() OVER (PARTITION BY r.batch ORDER BY len(k.ids) DESC, k.doc_id) AS place "
    "FROM known k JOIN rk r ON k.doc_id = r.doc_id",
)
def l07_longest_first(spark, sf_dir):
    from tonalert.operators.splits import batches

    ids = V.known_indices(fx.tagged(spark, sf_dir), known_vocab(spark, sf_dir))
    b = batches(ids, "doc_id", BATCH, fx.SPLIT_SEED)
    out = V.longest_first(b, "ids", batch_col="batch", key="doc_id")
    return normalise(out.select("doc_id", "batch", F.size("ids").alias("length"), "place"))


_NEAR = "('0x' || substr(md5(near), {}, 8))::BIGINT"


@register(
    "s08_fit_vectors",
    with_ctes(q.tagged_docs_cte())
    + ", pairs AS (SELECT a.tok AS word, b.tok AS near, count(*) AS n FROM tagged_docs a JOIN tagged_docs b ON a.doc_id = b.doc_id "
    "AND b.pos BETWEEN a.pos - 2 AND a.pos + 2 AND a.pos <> b.pos GROUP BY ALL), "
    f"sums AS (SELECT word, {_NEAR.format(1)} % 64 AS dim, sum(CASE WHEN {_NEAR.format(9)} % 2 = 1 THEN n ELSE -n END)::BIGINT AS total FROM pairs GROUP BY ALL), "
    "counts AS (SELECT tok AS word, count(*) AS cnt FROM tagged_docs WHERE tok IN (SELECT word FROM sums) GROUP BY tok), "
    "numbered AS (SELECT word, row_number() OVER (ORDER BY cnt DESC, word) - 1 AS idx FROM counts) "
    "SELECT word, idx, count(*) AS n_dims, sum(total * total)::BIGINT AS squares, md5(string_agg(dim || ':' || total, ',' ORDER BY dim)) AS sums_md5 "
    "FROM numbered JOIN sums USING (word) GROUP BY word, idx",
)
def s08_fit_vectors(spark, sf_dir):
    """S8 without a prepared table: vectors fitted from all documents, written, read back; beside them the exact sums."""
    docs = fx.tagged(spark, sf_dir).select("tokens")
    exact = reliable_checkpoint(V.context_sums(docs))  # read by the fit and below
    known = read_vocab_or_fit(spark, scratch_path(spark, "vectors"), lambda: V.fit_vectors(docs, sums=exact)).select("word", "idx")
    sums = exact.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_dims"), F.sum(F.col("total") * F.col("total")).alias("squares"),
        F.sort_array(F.collect_list(F.struct("dim", "total"))).alias("s"))
    line = F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["dim"].cast("string"), x["total"].cast("string"))), ",")
    return normalise(known.join(sums, "word").select("word", "idx", "n_dims", "squares", F.md5(line.cast("binary")).alias("sums_md5")))
