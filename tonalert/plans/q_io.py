"""Round trips through the sources and sinks (S1-S4, S8, K1, K2, K4) over tables that Spark
derives from the supplied ones: each query writes with a sink into a fresh folder inside the shared
checkpoint folder, reads the files back with a source, and returns the rows read. The DuckDB text
states what must come back: the rows that went in. S7 (the missing-input policy) is here too."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.constants import BIO_LABELS
from tonalert.functions import arrays as A
from tonalert.operators import splits as S
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.q_arrays import _vocab_cte, known_vocab
from tonalert.plans.registry import normalise, register, with_ctes
from tonalert.session import scratch_path
from tonalert.sources import io

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("text", T.StringType()),
])


@register("s02_read_table_csv", "SELECT doc_id, lang, source, text FROM documents")
def s02_read_table_csv(spark, sf_dir):
    """K1 as CSV with a header, then S2: whole texts, with quotes, commas and line breaks."""
    path = scratch_path(spark, "documents-csv")
    io.write_table(fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), path, fmt="csv")
    return normalise(io.read_table_csv(spark, path, DOC_SCHEMA, multi_line=True))


@register(
    "s03_read_captions",
    "SELECT item_id AS image_name, CAST(item_id % 5 AS VARCHAR) AS comment_number, "
    "text AS comment FROM benchmark",
)
def s03_read_captions(spark, sf_dir):
    """Captions written ``|``-separated with a header and every field quoted, then S3: quoted
    texts come back exactly, line breaks included."""
    path = scratch_path(spark, "captions")
    caps = fx.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("image_name"),
        F.pmod("item_id", F.lit(5)).cast("string").alias("comment_number"),
        F.col("text").alias("comment"))
    caps.write.option("header", True).option("sep", "|").option("escape", '"').option("quoteAll", True).csv(path)
    out = io.read_captions(spark, path, multi_line=True)
    return normalise(out.select(F.col("image_name").cast("bigint").alias("image_name"), "comment_number", "comment"))


@register(
    "s04_read_tagged",
    with_ctes(q.tagged_docs_cte(), q.splits_cte())
    + f", tags AS (SELECT doc_id, string_agg(CAST(tag AS VARCHAR), ' ' ORDER BY pos) AS ner_tags FROM tagged_docs "
    "GROUP BY doc_id) "
    "SELECT CAST(t.doc_id AS VARCHAR) AS id, s.split, CAST(len(t.toks) AS BIGINT) AS n_tokens, "
    "array_to_string(t.toks, ' ') AS tokens, coalesce(g.ner_tags, '') AS ner_tags, "
    "CAST(NULL AS BIGINT) AS n_pos_tags FROM tok_lists t JOIN splits s ON t.doc_id = s.doc_id "
    "LEFT JOIN tags g ON t.doc_id = g.doc_id",
)
def s04_read_tagged(spark, sf_dir):
    """The token corpus written as Parquet, one folder per split, then S4 with its declared schema
    (codes as integers; the corpus here has no part-of-speech or chunk tags, so those read NULL)."""
    path = scratch_path(spark, "tagged")
    # The split is assigned on the document rows (a broadcast bucket table; only rows of buckets
    # that straddle the cut are ranked and shuffled), then the rows are tokenised and tagged where
    # they are: the token arrays are never joined or shuffled.
    docs = S.split_exact(fx.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id",
                         fx.TRAIN_FRACTION, fx.SPLIT_SEED)
    t = fx.tagged(spark, sf_dir, docs=docs, carry=("split",))
    corpus = t.select(F.col("doc_id").cast("string").alias("id"), "tokens",
                      F.col("ner_tags").cast("array<int>").alias("ner_tags"), "split")
    corpus.write.partitionBy("split").parquet(path)
    back = io.read_tagged(spark, path)
    return normalise(back.select(
        "id", "split", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"),
        F.array_join(F.transform("ner_tags", lambda x: x.cast("string")), " ").alias("ner_tags"),
        F.size("pos_tags").cast("bigint").alias("n_pos_tags")))


@register(
    "k02_write_by_split",
    "WITH g AS (SELECT DISTINCT source FROM documents), "
    f"gr AS (SELECT source, row_number() OVER (ORDER BY md5(CAST(source AS VARCHAR) || ':{fx.SPLIT_SEED}'), source) "
    "AS rk, count(*) OVER () AS n FROM g), "
    "glab AS (SELECT source, CASE WHEN rk <= CAST(floor(0.8 * n) AS BIGINT) THEN 'train' "
    "WHEN rk <= CAST(floor(0.8 * n) AS BIGINT) + CAST(floor(0.1 * n) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM gr) "
    "SELECT d.doc_id, g.split, CASE WHEN g.split = 'test' THEN 'test' ELSE 'train' END AS dir "
    "FROM documents d LEFT JOIN glab g ON d.source IS NOT DISTINCT FROM g.source",
)
def k02_write_by_split(spark, sf_dir):
    """K2 over a three-way split by group (L2): test rows go to ``test``, train and val to ``train``."""
    path = scratch_path(spark, "by-split")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "source")
    labelled = S.split_groups(docs, "source", seed=fx.SPLIT_SEED).select("doc_id", "split")
    io.write_by_split(labelled, path)
    return normalise(spark.read.parquet(path).select("doc_id", "split", "dir"))


@register("k04_ingest_once", "SELECT doc_id, lang FROM documents")
def k04_ingest_once(spark, sf_dir):
    """K4: a second ingest into the same folder leaves the first one in place."""
    path = scratch_path(spark, "ingest")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "lang")
    io.ingest_once(docs, path)
    io.ingest_once(docs.select("doc_id", F.upper("lang").alias("lang")), path)
    return normalise(spark.read.parquet(path))


@register(
    "s08_read_vocab",
    with_ctes(_vocab_cte())
    + "SELECT v.word, v.idx, round(CAST(e.embedding[1] AS DOUBLE), 6) AS v0, CAST(len(e.embedding) AS BIGINT) AS dim "
    "FROM vocab v JOIN embeddings e ON e.vec_id = v.idx",
)
def s08_read_vocab(spark, sf_dir):
    """The prepared vector table written once (K4), then read by S8."""
    path = scratch_path(spark, "vocab")
    voc = known_vocab(spark, sf_dir)
    io.ingest_once(voc.select("word", F.col("idx").cast("long"), F.col("vector").cast("array<float>")), path)
    back = io.read_vocab(spark, path)
    return normalise(back.select("word", "idx", F.round(F.get("vector", 0).cast("double"), 6).alias("v0"),
                                 F.size("vector").alias("dim")))


@register(
    "k04_ingest_new",
    "SELECT doc_id, lang, 1::BIGINT AS copies FROM documents",
)
def k04_ingest_new(spark, sf_dir):
    """K4 over a growing folder: files are added twice, and each is ingested once; a call without new files adds nothing."""
    source, target = scratch_path(spark, "incoming"), scratch_path(spark, "ingested")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "lang")
    half = F.xxhash64("doc_id") % 2 == 0
    for part in (docs.where(half), docs.where(~half), None):
        if part is not None:
            part.write.mode("append").parquet(source)
        io.ingest_new(spark, f"{source}/*.parquet", target, lambda paths: spark.read.parquet(*paths))
    return normalise(io.read_ingested(spark, target).groupBy("doc_id", "lang").agg(F.count(F.lit(1)).alias("copies")))


# Lines as another program might write them: some without a number, some cut short.
_BROKEN = ("CASE WHEN doc_id % 11 = 0 THEN doc_id::VARCHAR || ',' || lang WHEN doc_id % 7 = 0 THEN doc_id::VARCHAR || ',' || lang || ',n/a' "
           "ELSE doc_id::VARCHAR || ',' || lang || ',' || n_chars::VARCHAR END")


@register(
    "s02_rejects",
    "SELECT doc_id, lang, CASE WHEN doc_id % 11 <> 0 AND doc_id % 7 <> 0 THEN n_chars END AS n_chars, "
    f"CASE WHEN doc_id % 11 = 0 OR doc_id % 7 = 0 THEN {_BROKEN} END AS line FROM documents",
)
def s02_rejects(spark, sf_dir):
    """S2 with a quarantine: broken lines are found, with their text; the other rows are as they were."""
    path = scratch_path(spark, "lines")
    docs = fx.table(spark, sf_dir, "documents")
    number = F.when(F.col("doc_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("n_chars").cast("string"))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), "lang", F.when(F.col("doc_id") % 11 != 0, number))
    docs.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType())])
    rows, rejects = io.read_with_rejects(spark, path, schema)
    held = rejects.select(F.split("line", ",")[0].cast("bigint").alias("doc_id"), F.split("line", ",")[1].alias("lang"),
                          F.when(F.lit(False), F.col("parsed.n_chars")).alias("n_chars"), "line")
    return normalise(rows.withColumn("line", F.lit(None).cast("string")).unionByName(held))


@register(
    "s01_read_tweets",
    "SELECT CAST((doc_id % 2) * 4 AS BIGINT) AS target, doc_id AS ids, lang AS date, 'NO_QUERY' AS flag, source AS user, "
    "regexp_replace(text, '[^\\x{00}-\\x{ff}]', '?', 'g') AS text FROM documents",
)
def s01_read_tweets(spark, sf_dir):
    """Tweet rows written as headerless Latin-1 CSV (code points above U+00FF become ``?``, as a
    Latin-1 encoder writes them), then S1."""
    path = scratch_path(spark, "tweets")
    docs = fx.table(spark, sf_dir, "documents")
    rows = docs.select(
        (F.pmod("doc_id", F.lit(2)) * 4).cast("int").alias("target"), F.col("doc_id").alias("ids"),
        F.col("lang").alias("date"), F.lit("NO_QUERY").alias("flag"), F.col("source").alias("user"),
        F.regexp_replace("text", r"[^\x{00}-\x{ff}]", "?").alias("text"))
    (rows.write.option("header", False).option("encoding", "ISO-8859-1").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return normalise(io.read_tweets(spark, path, multi_line=True))


@register(
    "s05_read_tag_names",
    with_ctes(q.tagged_docs_cte())
    + ", ns AS (SELECT 'pos_tags' AS feature, list(DISTINCT lang ORDER BY lang) AS names FROM documents "
    "UNION ALL SELECT 'chunk_tags', list(DISTINCT source ORDER BY source) FROM documents "
    f"UNION ALL SELECT 'ner_tags', {q.sql_list(list(BIO_LABELS.values()))}) "
    "SELECT l.doc_id, array_to_string(list_transform(toks, lambda t, i: p.names[(doc_id + i - 1) % len(p.names) + 1]), ' ') AS pos_names, "
    "array_to_string(list_transform(toks, lambda t, i: c.names[(doc_id * 3 + i - 1) % len(c.names) + 1]), ' ') AS chunk_names, "
    "coalesce((SELECT string_agg(n.names[g.tag + 1], ' ' ORDER BY g.pos) FROM tagged_docs g WHERE g.doc_id = l.doc_id), '') AS ner_names "
    "FROM tok_lists l, ns p, ns c, ns n WHERE p.feature = 'pos_tags' AND c.feature = 'chunk_tags' AND n.feature = 'ner_tags'",
)
def s05_read_tag_names(spark, sf_dir):
    """A dataset description is written with the names of three tag columns (languages,
    sources and the entity tags), read back, and decodes the codes of all three columns."""
    docs = fx.table(spark, sf_dir, "documents")
    path = scratch_path(spark, "description")

    kinds = docs.agg(F.sort_array(F.collect_set("lang")).alias("l"), F.sort_array(F.collect_set("source")).alias("s"))
    info = kinds.select(F.struct(
        F.struct(F.struct(F.col("l").alias("names")).alias("feature")).alias("pos_tags"),
        F.struct(F.struct(F.col("s").alias("names")).alias("feature")).alias("chunk_tags"),
        F.struct(F.struct(F.array(*[F.lit(n) for n in BIO_LABELS.values()]).alias("names")).alias("feature")).alias("ner_tags")).alias("features"))
    info.write.json(path)
    read = io.read_tag_names(spark, path)
    table = read.groupBy().pivot("feature", ["pos_tags", "chunk_tags", "ner_tags"]).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("idx", "name"))), lambda x: x["name"]))
    n = {f: F.size(f"{f}_names") for f in ("pos_tags", "chunk_tags")}
    rows = fx.tagged(spark, sf_dir).crossJoin(F.broadcast(table.toDF("pos_tags_names", "chunk_tags_names", "ner_tags_names")))  # one row
    codes = {"pos_tags": F.transform("tokens", lambda t, i: F.pmod(F.col("doc_id") + i, n["pos_tags"])),
             "chunk_tags": F.transform("tokens", lambda t, i: F.pmod(F.col("doc_id") * 3 + i, n["chunk_tags"])), "ner_tags": F.col("ner_tags")}
    return normalise(rows.select("doc_id", *[F.array_join(A.decode_tags(codes[f], F.col(f"{f}_names")), " ").alias(f.replace("tags", "names")) for f in codes]))


@register(
    "s06_read_images",
    "SELECT CAST(sum(octet_length(encode(text || chr(10)))) AS BIGINT) AS bytes, CAST(1 AS BIGINT) AS only_listed FROM documents",
)
def s06_read_images(spark, sf_dir):
    """Files that Spark writes from the documents; those with another extension are never listed."""
    path = scratch_path(spark, "binary")
    docs = fx.table(spark, sf_dir, "documents").select("text")
    docs.write.option("compression", "none").text(f"{path}/a")
    docs.write.json(f"{path}/b")
    found = io.read_images(spark, f"{path}/*", (".TXT",), ignore_case=True)
    return normalise(found.agg(F.sum("length").alias("bytes"), F.min(F.col("path").endswith(".txt").cast("int")).alias("only_listed")))


_PAGE_SPLIT = (
    f"pg AS (SELECT page_id, row_number() OVER (ORDER BY md5(page_id || '.html' || ':{fx.SPLIT_SEED}'), page_id || '.html') AS rk, count(*) OVER () AS n FROM pages "
    "WHERE page_id % 10 <> 3), "
    "pages_split AS (SELECT page_id, CASE WHEN rk <= CAST(floor(0.8 * n) AS BIGINT) THEN 'train' "
    "WHEN rk <= CAST(floor(0.8 * n) AS BIGINT) + CAST(floor(0.1 * n) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM pg) "
)


def _page_files(spark, sf_dir):
    """Pages as files: path and bytes."""
    return fx.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("store/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.col("html").cast("binary").alias("content"))


@register(
    "k05_write_images_by_split",
    "WITH " + _PAGE_SPLIT + "SELECT p.page_id || '.html' AS image_name, coalesce(s.split, 'unlisted') AS split, "
    "CAST(octet_length(encode(p.html)) AS BIGINT) AS bytes FROM pages p LEFT JOIN pages_split s USING (page_id)",
)
def k05_write_images_by_split(spark, sf_dir):
    """K5: pages as files, the manifest from a split by name (L2) that lists nine in ten."""
    path = scratch_path(spark, "images")
    files = _page_files(spark, sf_dir)
    listed = fx.table(spark, sf_dir, "pages").where("page_id % 10 <> 3").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("image_name"))
    io.write_images_by_split(files, S.split_groups(listed, "image_name", seed=fx.SPLIT_SEED), path)
    return normalise(spark.read.parquet(path).select("image_name", "split", F.octet_length("content").cast("bigint").alias("bytes")))


@register(
    "m07_caption_images",
    "SELECT page_id || '.html' AS image_name, octet_length(encode(html)) || ' bytes' AS caption FROM pages",
)
def m07_caption_images(spark, sf_dir):
    """M7 with a stand-in captioner (the length of the bytes)."""
    from tonalert.operators.models import caption_images

    def loader():
        return lambda contents: [(f"{len(c)} bytes",) for c in contents]

    return normalise(caption_images(_page_files(spark, sf_dir), loader, batch=50))


@register("s07_on_missing", "SELECT doc_id, lang FROM documents")
def s07_on_missing(spark, sf_dir):
    """A required input is read under ``error``; an optional one that is absent is reported
    and skipped under ``skip`` (the rows come from the inputs that exist)."""
    parts = [
        io.on_missing(lambda: fx.table(spark, sf_dir, "documents"), "error", "documents"),
        io.on_missing(lambda: spark.read.parquet(scratch_path(spark, "never-written")), "skip", "optional documents"),
    ]
    present = [p.select("doc_id", "lang") for p in parts if p is not None]
    out = present[0]
    for p in present[1:]:
        out = out.unionByName(p)
    return normalise(out)
