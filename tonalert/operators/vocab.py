"""Vocabulary operators (J3, J4, A5, A6): word -> index, index -> vector, padded batches.

Plan shape of ``words_to_idx``: a vocabulary of small measured size is looked up in the row, in Arrow batches, without a
shuffle. Beyond that tokens are exploded and joined inner (a shuffle join whose hot words AQE splits), so only hits move on, and
regrouped by a row number (partial aggregation first; a row's group is bounded by its own token count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonalert.functions import arrays as A
from tonalert.functions import text as TX
from tonalert.operators.joins import checked_broadcast, measured_bytes
from tonalert.operators.taggers import ROW, TRIE_LIMIT_BYTES, numbered_rows
from tonalert.session import reliable_checkpoint

_PART_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def number_rows(df: DataFrame, *order, col: str = "idx") -> DataFrame:
    """``col`` = 0, 1, 2, ... in the order given, without a sort in one task: a range sort, row numbers
    per range kept in a table (so the ranges stay as they are), and the rows before each range.
    The range counts are one row per partition. Jobs run when this is called."""
    ranged = reliable_checkpoint(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", _PART_BITS)
    sizes = ranged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    out = ranged.withColumn("_p", part).join(offsets, "_p")
    return out.withColumn(col, F.col("_before") + F.col("_at").bitwiseAND((1 << _PART_BITS) - 1)).drop("_p", "_at", "_before")


def build_vocab(docs: DataFrame, text: str = "text") -> DataFrame:
    """every word (count desc, then word), ``idx`` from 0. Word counts are a partial-then-final
    aggregation (hot words are combined map-side)."""
    words = TX.words(F.coalesce(F.col(text), F.lit("")))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return number_rows(counts, F.col("cnt").desc(), F.col("word")).select("word", "idx", "cnt")


TOP_WORDS = 200_000  # words that are kept in order while counting; more are numbered by a range sort


def top_vocab(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """The first ``n`` rows of ``build_vocab``. Of up to TOP_WORDS words only these are sorted (each task keeps its best), not all."""
    if n > TOP_WORDS:
        return build_vocab(docs, text).where(F.col("idx") < n)
    words = TX.words(F.coalesce(F.col(text), F.lit("")))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    order = [F.col("cnt").desc(), F.col("word")]
    best = counts.orderBy(*order).limit(n)  # bounded by TOP_WORDS
    return best.select("word", (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint").alias("idx"), "cnt")


def attach_vectors(vocab: DataFrame, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                   known_only: bool = False) -> DataFrame:
    """Vocabulary rows with their vector (``vectors.vec_id = vocab.idx``); ``known_only``: words that
    have one."""
    v = vectors.select(F.col(id_col).alias("idx"), F.col(vec_col).alias("vector"))
    return vocab.join(v, "idx", "inner" if known_only else "left")


def _known_lists(lists, known: dict):
    """The numbers of the known words of a batch of token lists, in order; equal words are looked up once."""
    import numpy as np
    import pyarrow as pa

    lists = lists.cast(pa.list_(pa.string()))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    number = np.array([known.get(w, -1) for w in coded.dictionary.to_pylist()] + [-1], np.int64)
    found = number[coded.indices.fill_null(len(number) - 1).to_numpy(zero_copy_only=False)]
    hit = found >= 0
    before = np.concatenate(([0], np.cumsum(hit)))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return pa.ListArray.from_arrays(pa.array(before[ends], pa.int32()), pa.array(found[hit]))


def known_indices(df: DataFrame, vocab: DataFrame, key: str = "doc_id", toks: str = "tokens", limit: int = TRIE_LIMIT_BYTES) -> DataFrame:
    """Indices of the known words of each row, in token order (possibly empty): ``(key, ids)``; keys may repeat or be NULL.

    A vocabulary of at most ``limit`` measured bytes goes to the tasks once and rows are looked up where they are. Beyond that
    rows get numbers of their own, the tokens are joined inner with the vocabulary, so only hits move on, and these are regrouped by
    row. A word that the vocabulary lists twice has its smallest index."""
    words = vocab.where("word IS NOT NULL AND idx IS NOT NULL").groupBy("word").agg(F.min("idx").cast("bigint").alias("idx"))
    words = reliable_checkpoint(words)
    if measured_bytes(words) <= limit:
        known = df.sparkSession.sparkContext.broadcast({r["word"]: r["idx"] for r in words.collect()})  # measured
        lookup = F.arrow_udf(lambda lists: _known_lists(lists, known.value), "array<bigint>")
        return df.select(key, lookup(F.col(toks)).alias("ids"))
    rows = numbered_rows(df.select(key, toks))
    hits = rows.select(ROW, F.posexplode(toks).alias("pos", "word")).join(checked_broadcast(words, materialize=False), "word")
    hits = hits.groupBy(ROW).agg(F.sort_array(F.collect_list(F.struct("pos", "idx"))).alias("_hits"))  # a row's own tokens
    ids = F.coalesce(F.transform("_hits", lambda p: p["idx"]), F.array().cast("array<bigint>"))
    return rows.join(hits, ROW, "left").select(key, ids.alias("ids"))


def words_to_idx(df: DataFrame, vocab: DataFrame, key: str = "doc_id", toks: str = "tokens") -> DataFrame:
    """Word -> index; unknown words dropped, order kept; no known word -> ``[0]``."""
    k = known_indices(df, vocab, key, toks)
    return k.select(key, F.when(F.size("ids") == 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.col("ids")).alias("ids"))


def idx_to_vector(ids: DataFrame, vocab_vectors: DataFrame, key: str = "doc_id", col: str = "ids", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per position with its vector: ``(key, pos, idx, vector)``. ``carry``: columns of ``vocab_vectors`` that
    go along, such as what is worked out of a vector once instead of at every place of its word."""
    e = ids.select(key, F.posexplode(col).alias("pos", "idx"))
    return e.join(checked_broadcast(vocab_vectors.select("idx", "vector", *carry), materialize=False), "idx", "left")


def pad_sequences(ids: DataFrame, batch_col: str = "batch", col: str = "ids") -> DataFrame:
    """A5: pad each batch to its longest with 0; ``length`` = max(n, 1).

    The longest length is a window over the batch (a batch is a few dozen rows).
    """
    w = Window.partitionBy(batch_col)
    longest = F.max(F.size(col)).over(w)
    return ids.withColumns({
        "length": F.greatest(F.size(col), F.lit(1)),
        "padded": A.pad_to(col, longest, 0),
    })


def longest_first(df: DataFrame, col: str = "ids", batch_col: str | None = None, key: str | None = None,
                  place: str = "place") -> DataFrame:
    """Longest sequence first inside a batch.

    Without ``batch_col`` a batch is a partition: a local sort, no shuffle. With it, every row gets
    its 1-based ``place`` in its batch by (length desc, ``key``): a window over one batch, whose
    size is fixed (L9), so no window partition can grow with the data."""
    if batch_col is None:
        return df.sortWithinPartitions(F.size(col).desc())
    order = [F.size(col).desc()] + ([F.col(key)] if key else [])
    return df.withColumn(place, F.row_number().over(Window.partitionBy(batch_col).orderBy(*order)))


CONTEXT_TOKENS = 2_000_000  # tokens whose contexts a task adds up at a time


def context_sums(df: DataFrame, tokens: str = "tokens", dims: int = 64, reach: int = 2) -> DataFrame:
    """(word, dim, total): the words around each word, projected at random. A neighbour within ``reach`` places adds one, with the
    sign and at the place that the MD5 of its text gives. Tasks add up the contexts of many rows at a time, so what
    is shuffled are sums by word and place, not pairs of words, and no vocabulary leaves the tasks."""
    def added(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(0).cast(pa.list_(pa.string()))
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = sizes.cumsum()
            a = 0
            while a < len(lists):
                b = max(a + 1, int(ends.searchsorted((ends[a - 1] if a else 0) + CONTEXT_TOKENS, side="right")))
                yield _added_contexts(lists.slice(a, b - a), sizes[a:b], dims, reach)
                a = b

    parts = df.select(tokens).mapInArrow(added, "word string, dim int, total bigint")
    return parts.groupBy("word", "dim").agg(F.sum("total").alias("total"))


def _added_contexts(lists, sizes, dims: int, reach: int):
    """The context sums of some token lists as (word, dim, total)."""
    import hashlib

    import numpy as np
    import pyarrow as pa

    coded = lists.flatten().dictionary_encode()
    code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    digests = b"".join(hashlib.md5(w.encode()).digest()[:8] for w in coded.dictionary.to_pylist())
    numbers = np.frombuffer(digests, ">u4").astype(np.int64).reshape(-1, 2)
    dim, sign = numbers[:, 0] % dims, numbers[:, 1] % 2 * 2 - 1
    row = np.repeat(np.arange(len(sizes)), sizes)
    cells, signs = [], []
    for o in range(1, reach + 1):
        both = (row[o:] == row[:-o]) & (code[o:] >= 0) & (code[:-o] >= 0)
        left, right = code[:-o][both], code[o:][both]
        cells += [left * dims + dim[right], right * dims + dim[left]]
        signs += [sign[right], sign[left]]
    cell, at = np.unique(np.concatenate(cells), return_inverse=True)
    total = np.bincount(at, np.concatenate(signs), len(cell)).astype(np.int64)
    words = coded.dictionary.take(pa.array(cell // dims))
    return pa.RecordBatch.from_arrays([words, pa.array((cell % dims).astype(np.int32)), pa.array(total)], names=["word", "dim", "total"])


def fit_vectors(df: DataFrame, tokens: str = "tokens", dims: int = 64, reach: int = 2, sums: DataFrame | None = None) -> DataFrame:
    """S8 where no table is given: (word, idx, vector) of every word with a neighbour. ``vector``: its sums of contexts
    (``context_sums``) at length 1; ``idx`` by frequency, then word. Words that stand in like places lie close together.
    ``sums``: the context sums of ``df`` where they are at hand."""
    sums = reliable_checkpoint(context_sums(df, tokens, dims, reach)) if sums is None else sums
    per = sums.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("dim", "total"))).alias("_m"),  # at most ``dims`` entries
                                   F.sqrt(F.sum(F.col("total").cast("double") * F.col("total"))).alias("_length"))
    each = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.coalesce(F.element_at("_m", d), F.lit(0)) / F.greatest("_length", F.lit(1e-9)))
    counts = df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    vectors = counts.join(per, "word").select("word", "cnt", each.alias("vector"))
    return number_rows(vectors, F.col("cnt").desc(), F.col("word")).select("word", "idx", F.col("vector").cast("array<float>").alias("vector"))
