"""Operator 7, line dedup by range-partitioned hashes (DataFrame functions only).

A line's key is the line stripped of ASCII white space and with A-Z lower-cased. The occurrences of
keys of at least MIN_CHARS code points are range-partitioned by (key hash, document) and sorted by
position, so each partition streams the first occurrence of every key in every document; a key
that very many documents hold spreads over several ranges, because the document is part of the
range key. Only first occurrences are counted (partial sums before the shuffle). Lines whose key is
in at least MIN_DOCS documents are dropped everywhere but in the largest doc_id that holds it. The
decisions come back as compressed keep bitmaps: per document the 64-line words that lose a line,
as (word, bits of the kept lines); words not listed keep all their lines. No text is shuffled.

Keys are compared by two 64-bit hashes. A document is a doc_id; NULL is one more document, never
the one that keeps a line unless it is the only one. Rows that repeat a doc_id with the same text
get the same bitmap; with different texts each gets its own, and they count as one document. A NULL
or empty text is one empty line, which has no key. Extra columns of any name pass through
``drop_lines``, but ``n_lines`` and ``n_dropped``, which are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tonalert.llm.common import stored, text_or_empty
from tonalert.operators.joins import checked_broadcast

MIN_CHARS = 20
MIN_DOCS = 3
HOT_SHARE = 1000


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.translate(stripped, string.ascii_uppercase, string.ascii_lowercase)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, row_hash, pos) of every line whose key is long enough."""
    t = text_or_empty()
    lines = docs.select("doc_id", F.xxhash64(t).alias("row_hash"), F.posexplode(_lines(t)).alias("pos", "line"))
    keyed = lines.where(F.octet_length("line") >= min_chars).select("doc_id", "row_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "row_hash", "pos")


def occurrence_index(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The occurrences in range order, with ``first`` on the first one of each key in each
    document. The window needs no exchange of its own: the ranges keep (h1, h2, doc_id) together."""
    # The texts are split once: the ranges are sampled from the stored occurrences.
    ranged = stored(occurrences(docs, min_chars), "line-occurrences").repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", "doc_id", "pos")
    stream = W.partitionBy("h1", "h2", "doc_id").orderBy("pos")
    return stored(ranged.withColumn("first", F.row_number().over(stream) == 1), "line-index")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row_hash, n_dropped, words array<struct<word, keep>>) of the documents that lose lines."""
    index = occurrence_index(docs, min_chars)
    counts = index.where("first").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    often = stored(counts.where(F.col("n") >= min_docs), "line-often")
    # Keys of more than one in HOT_SHARE occurrences are at most HOT_SHARE: they are broadcast, so no task gets all lines of
    # one. The others are joined by key.
    share = F.lit(index.count()) < F.col("n") * HOT_SHARE
    hot, rare = F.broadcast(often.where(share).drop("n")), often.where(~share).drop("n")
    rest = index.join(hot.drop("keeper"), ["h1", "h2"], "left_anti").join(rare, ["h1", "h2"])
    lost = index.join(hot, ["h1", "h2"]).unionByName(rest).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = lost.select("doc_id", "row_hash", (F.col("pos") / 64).cast("int").alias("word"), bit.alias("bit")).groupBy(
        "doc_id", "row_hash", "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy("doc_id", "row_hash").agg(
        F.sum(F.bit_count("bits").cast("bigint")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("keep")))).alias("words"))


def dropped_positions(words: Column) -> Column:
    """Positions of the lines that a bitmap drops, ascending."""
    inside = F.transform(words, lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w["keep"], b) == 0), lambda b: w["word"] * 64 + b))
    return F.flatten(inside)


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` less its dropped lines, ``n_lines`` (before) and ``n_dropped``. The
    bitmaps are joined by (doc_id, hash of the text), broadcast only if measured small. A text that
    loses no line stays as it is (NULL becomes empty only where the caller asks for the text)."""
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    row = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("_row")  # no name can clash in there
    own = docs.select(row, "doc_id", "text", F.xxhash64(text_or_empty()).alias("row_hash"))
    side = checked_broadcast(stored(bitmaps, "line-bitmaps"), materialize=False)
    match = own["doc_id"].eqNullSafe(side["doc_id"]) & (own["row_hash"] == side["row_hash"])
    df = own.join(side, match, "left").select("_row", "text", "n_dropped", "words", _lines(text_or_empty()).alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), dropped_positions(F.col("words")))
    shorter = F.array_join(F.transform(stay, lambda p: F.get("lines", p)), "\n")
    text = F.when(F.col("n_dropped").isNull(), F.col("text")).otherwise(shorter)
    return df.select(*[text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in names],
                     F.size("lines").cast("bigint").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"))
