"""Operator 6, benchmark decontamination by a distributed positional inverted index.

Index: training documents are cut into segments of about SEGMENT_BYTES bytes of text. A segment is one row
that holds its documents (ids, first positions, word counts) and, for every term, the ascending
positions of the term in the segment. Documents never straddle segments, and a gap between
documents keeps phrases inside one. The segments are a Parquet table in the shared folder.

Search: the distinct phrases (windows) are looked up in each segment where it lies. A phrase starts
from the list of its rarest term, shifted by the term's offset, and is intersected with the shifted
lists of its other terms from rare to frequent until it is empty or done, so frequent lists are
only probed at surviving places. Rarity is counted over all segments. Phrases travel to the tasks
in blocks of at most PHRASE_BLOCK windows; each block is one pass over the segments.

Terms are compared by 64-bit hashes of the words (A-Z lower-cased). Edge cases: NULL or empty texts have no words and
are never hit; items without words have no windows; NULL item ids count as the text ''. Rows that
repeat a doc_id are separate documents, each with its own row. Long texts are never cut: a text
longer than a segment is a segment. An empty side gives no hits. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalert.llm.bytewords import ALNUM, hash_words, text_blocks, word_runs
from tonalert.llm.common import stored, text_or_empty

WINDOW = 10
SEGMENT_BYTES = 8_000_000
PHRASE_BLOCK = 200_000  # most windows that travel to the tasks at a time
MAX_TERMS = 4_000_000  # most term hashes (8 bytes each) that travel to the tasks
GAP = 1 << 10  # positions between documents; no phrase or proximity window may be longer

_FIELDS = ["doc_ids", "id_null", "row_hashes", "starts", "counts", "terms", "offsets", "positions"]


def build_index(docs: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """Segments of ``docs`` (doc_id, text). ``terms``: sorted hashes of the only terms to be kept
    (those the queries can ask for), None for all."""

    def segments(batches):
        import pyarrow as pa

        for batch in batches:
            ids, rows, column = batch.column("doc_id"), batch.column("row_hash"), batch.column("text")
            for at, n, data, ends in text_blocks(column, SEGMENT_BYTES):
                counts, n_words, parts = np.zeros(n, np.int64), 0, []
                for hashes, texts in word_runs(data, ends, ALNUM):
                    counts[texts[0]:texts[-1] + 1] += np.bincount(texts - texts[0])
                    position = n_words + np.arange(len(hashes)) + GAP * texts
                    n_words += len(hashes)
                    if terms is not None:
                        known = listed(terms, hashes) >= 0
                        hashes, position = hashes[known], position[known]
                    parts.append((hashes, position.astype("<i4")))
                hashes = np.concatenate([h for h, _ in parts] or [np.empty(0, np.uint64)])
                position = np.concatenate([p for _, p in parts] or [np.empty(0, "<i4")])
                starts = np.concatenate(([0], np.cumsum(counts)[:-1])) + GAP * np.arange(n)
                order = np.argsort(hashes, kind="stable")
                hashes, position = hashes[order], position[order]
                new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.empty(0, np.int64)
                own = ids.slice(at, n)
                row = [own.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), own.is_null().to_numpy(zero_copy_only=False),
                       rows.slice(at, n).to_numpy(zero_copy_only=False).astype("<i8"), starts.astype("<i8"),
                       counts.astype("<i8"), hashes[new].astype("<u8"), np.append(new, len(hashes)).astype("<i8"), position]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], names=_FIELDS)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_or_empty()).alias("row_hash"), "text")
    index = rows.mapInArrow(segments, ", ".join(f"{f} binary" for f in _FIELDS))
    return stored(index.select(F.monotonically_increasing_id().alias("segment"), *_FIELDS), "postings")


def listed(terms: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted ``terms``, -1 if it is not there."""
    if not len(terms):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return np.where(terms[at] == hashes, at, -1)


class Segment:
    """One row of the index, opened."""

    def __init__(self, row):
        self.id = row.get("segment")
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        self.id_null = np.frombuffer(row["id_null"], bool)
        self.row_hashes = np.frombuffer(row["row_hashes"], "<i8")
        self.starts = np.frombuffer(row["starts"], "<i8")
        self.counts = np.frombuffer(row["counts"], "<i8")
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.offsets = np.frombuffer(row["offsets"], "<i8")
        self.positions = np.frombuffer(row["positions"], "<i4")

    def postings(self, i):
        return self.positions[self.offsets[i]:self.offsets[i + 1]]

    def phrase(self, lists, order):
        """Start positions of a phrase. ``lists``: number of the posting list of each of its terms;
        ``order``: offsets in the phrase, from the rarest term to the most frequent."""
        found = self.postings(lists[order[0]]) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            found = found[listed(self.postings(lists[k]), found + k) >= 0]
        return found

    def near(self, terms, within):
        """Positions where a span of at most ``within`` words starts with one of ``terms`` and holds
        all of them, in any order. Only places around the rarest term are looked at."""
        lists = listed(self.terms, np.array(list(dict.fromkeys(terms)), np.uint64))
        if not len(lists) or lists.min() < 0:
            return np.empty(0, np.int64)
        lists = sorted((self.postings(i) for i in lists), key=len)
        starts = []
        for own in lists:
            low, high = np.searchsorted(own, lists[0] - within + 1), np.searchsorted(own, lists[0], side="right")
            starts += [own[a:b] for a, b in zip(low, high)]
        starts = np.unique(np.concatenate(starts)).astype(np.int64)
        for own in lists:
            at = np.searchsorted(own, starts)
            ok = at < len(own)
            ok[ok] = own[at[ok]] - starts[ok] < within
            starts = starts[ok]
        return starts

    def owner(self, position):
        """Place of the document that holds ``position``, and the word's place in it."""
        d = int(np.searchsorted(self.starts, position, side="right")) - 1
        return d, int(position - self.starts[d])


def _opened(batch):
    """The segments of a batch one after the other, read where they lie in Arrow's buffers."""
    for k in range(batch.num_rows):
        yield Segment({f: batch.column(f)[k].as_py() if f == "segment" else batch.column(f)[k].as_buffer() for f in batch.schema.names})


def term_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How often each of ``terms`` (sorted) occurs in the whole index; summed per task before the
    shuffle, one row per queried term in the end."""

    def counted(batches):
        import pyarrow as pa

        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                at = listed(terms, np.frombuffer(batch.column("terms")[k].as_buffer(), "<u8"))
                total[at[at >= 0]] += np.diff(np.frombuffer(batch.column("offsets")[k].as_buffer(), "<i8"))[at >= 0]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    out = np.zeros(len(terms), np.int64)
    sums = index.select("terms", "offsets").mapInArrow(counted, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    for r in sums.toLocalIterator():
        out[r["term"]] = r["n"]
    return out


def _item_windows(items, size):
    """Distinct windows (tuples of term hashes) of the items and the items that hold each."""
    owners: dict = {}
    for item, hashes in zip([i for i, _ in items], hash_words([t for _, t in items], ALNUM)):
        words = hashes.tolist()
        for k in range(max(1, len(words) - size + 1) if words else 0):
            owners.setdefault(tuple(words[k:k + size]), set()).add(item)
    return owners


def _phrase_blocks(benchmark: DataFrame, size: int):
    """Blocks of about PHRASE_BLOCK windows at most, read item by item: the driver holds one block."""
    items, n = [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").toLocalIterator():
        items.append((row["item"], row["text"]))
        n += len(row["text"] or "") // 2
        if n >= PHRASE_BLOCK:
            yield _item_windows(items, size)
            items, n = [], 0
    if items:
        yield _item_windows(items, size)


def search(index: DataFrame, owners: dict) -> DataFrame:
    """One row per indexed document: segment, place, doc_id, row_hash, n_words, ``hit`` (places of
    the words that some window covers) and ``items`` (those whose windows occur)."""
    terms = np.array(sorted({w for words in owners for w in words}), np.uint64)
    rarity = dict(zip(terms.tolist(), term_counts(index, terms).tolist()))
    # A term that occurs nowhere ends its phrase here.
    phrases: dict = {}  # by the rarest term
    for words, items in owners.items():
        if all(rarity[w] for w in words):
            order = sorted(range(len(words)), key=lambda k: rarity[words[k]])
            phrases.setdefault(words[order[0]], []).append((words, order, sorted(items)))
    rarest = np.array(sorted(phrases), np.uint64)

    def found(batches):
        import pyarrow as pa

        for batch in batches:
            for s in _opened(batch):
                n = len(s.doc_ids)
                cover, items = [set() for _ in range(n)], [set() for _ in range(n)]
                where = {t: i for i, t in enumerate(s.terms.tolist())}
                here = s.terms[listed(rarest, s.terms) >= 0].tolist()
                for words, order, held_by in (x for t in here for x in phrases[t]):
                    lists = [where.get(w, -1) for w in words]
                    if min(lists) < 0:
                        continue
                    for p in s.phrase(lists, order).tolist():
                        d, at = s.owner(p)
                        cover[d].update(range(at, at + len(words)))
                        items[d].update(held_by)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s.id] * n, pa.int64()), pa.array(np.arange(n)), pa.array(s.doc_ids, pa.int64(), mask=s.id_null), pa.array(s.row_hashes),
                     pa.array(s.counts), pa.array([sorted(c) for c in cover], pa.list_(pa.int32())),
                     pa.array([sorted(i) for i in items], pa.list_(pa.string()))],
                    names=["segment", "place", "doc_id", "row_hash", "n_words", "hit", "items"])

    return index.mapInArrow(found, "segment bigint, place bigint, doc_id bigint, row_hash bigint, n_words bigint, hit array<int>, items array<string>")


def proximity_matches(index: DataFrame, phrase: str, within: int) -> DataFrame:
    """(doc_id, position): spans of at most ``within`` words (less than GAP) that hold all words of
    ``phrase`` in any order, by the word they start with."""
    terms = hash_words([phrase], ALNUM)[0].tolist()

    def found(batches):
        import pyarrow as pa

        for batch in batches:
            for s in _opened(batch):
                at = [s.owner(p) for p in s.near(terms, within)]
                d = np.array([x for x, _ in at], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(s.doc_ids[d], pa.int64(), mask=s.id_null[d]), pa.array([x for _, x in at], pa.int64())],
                                                 names=["doc_id", "position"])

    return index.mapInArrow(found, "doc_id bigint, position bigint")


def benchmark_terms(benchmark: DataFrame) -> np.ndarray | None:
    """Sorted distinct term hashes of the benchmark, block by block; None (index all terms) if there
    are more than MAX_TERMS."""
    terms = np.empty(0, np.uint64)
    for owners in _phrase_blocks(benchmark, 1):
        terms = np.union1d(terms, np.array([w[0] for w in owners], np.uint64))
        if len(terms) > MAX_TERMS:
            return None
    return terms


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row_hash, n_words, hit array<int> (places of hit words), items array<string>: one row
    per document."""
    index = build_index(docs, benchmark_terms(benchmark))
    parts = [search(index, owners) for owners in _phrase_blocks(benchmark, window)] or [search(index, {})]
    out = parts[0]
    if len(parts) > 1:  # a document's results from all blocks
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("segment", "place").agg(
            *[F.first(c).alias(c) for c in ("doc_id", "row_hash", "n_words")],
            *[F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("hit", "items")])
    return out.drop("segment", "place")
