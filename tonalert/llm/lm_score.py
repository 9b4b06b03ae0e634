"""Operator 10, language-model scores by a weighted backoff automaton.

Model: words after the one and the two words before them over all training texts, smoothed order by order,

    P0(w)       = (c(w) + 0.5) / (N + 0.5 (V + 1))
    P(w | v)    = (c(v w) + MASS * P0(w)) / (c(v) + MASS)
    P(w | u v)  = (c(u v w) + MASS_TWO * P(w | v)) / (c(u v) + MASS_TWO)   where c(u v) >= MIN_CONTEXT, else P(w | v)

as an automaton (``Automaton``): the state without memory, a state per known word v, and one per pair u v of at least
MIN_CONTEXT training occurrences. A counted word after a state's context is an arc with the weight log P, to the state of the
longest context that the words then end with. A state's failure arc leads to that of its context less the first word, at the weight
log(MASS / (c + MASS)) of its count c. A text is read once from left to right: at each word the state is left by its
arc, or by failure arcs, as many as it takes, until a state has one; weights add up. A text starts in a start state
and ends with an end token.

The automaton grows with the corpus, so no task holds it. Texts become blocks of about BLOCK_BYTES
bytes. Each block asks for its distinct words and pairs, and then for the triples whose pairs the answers
leave possible, once each, with its own training counts; the requests are dealt by ranges of their hashes, summed, and
every block gets the totals back in the order it asked, so the answers carry no keys. A frequent word is one request per
block, so ranges stay even; a block sends no empty requests, so there are never more than its tokens. The block then
builds the part of the automaton that its texts pass through, and scores them.

Words are 64-bit hashes of the bytes with A-Z lower-cased. Edge cases: a NULL or empty text is one end token.
NULL ids fall in fold 0 (training); repeated rows count and score as often as they occur. A text longer than a block is
a block. Without training texts N and V are 0 and all probabilities are equal. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalert.llm.bytewords import NOT_SPACE, mix, text_blocks, words_of
from tonalert.llm.common import stored

MASS = 300.0  # weight of the words' own distribution in the state of a word
MASS_TWO = 30.0  # weight of the distribution after a word in the state of a pair
MIN_CONTEXT = 4  # training occurrences of a pair that has a state
BLOCK_BYTES = 8_000_000
RANGE_TOKENS = 2_000_000  # corpus tokens per range of request hashes
MIN_RANGES = 64
_U = np.uint64
START, END = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)


def pack(values: np.ndarray) -> bytes:
    """Integers, compressed with like bytes side by side."""
    import zstandard

    width = values.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def pack_sorted(hashes: np.ndarray) -> bytes:
    return pack(np.diff(hashes, prepend=_U(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def text_tokens(data, ends):
    """Hashes of all texts' tokens (words, then one end) and first[i]:first[i + 1], those of text i."""
    words = words_of(data, ends, NOT_SPACE)
    counts = words.counts()
    first = np.append(0, np.cumsum(counts + 1)).astype(np.int64)
    out = np.full(int(first[-1]), END, np.uint64)
    out[np.arange(len(words.hashes)) + np.repeat(np.arange(len(counts)), counts)] = words.hashes
    return out, first


def bigram_hashes(vocabulary: np.ndarray, token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of (word before, word) at every token; the first token of a text follows START."""
    own = vocabulary[token]
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[first[:-1]] = START
    return mix(mix(before) + own)


_BLOCK = {"doc_ids": "i8", "id_null": "?", "train": "?", "first": "i8", "vocabulary": "u8", "token": "u4"}


def blocks(docs: DataFrame, train: Column) -> DataFrame:
    """The texts as blocks of numbered words, a table in the shared folder: one pass over the texts."""

    def made(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, n, data, ends in text_blocks(batch.column("text"), BLOCK_BYTES):
                hashes, first = text_tokens(data, ends)
                vocabulary, token = np.unique(hashes, return_inverse=True)
                ids = batch.column("doc_id").slice(at, n)
                flags = batch.column("train").slice(at, n).to_numpy(zero_copy_only=False)
                row = {"block": serial, "tokens": len(token), "train_tokens": int(np.diff(first)[flags].sum()),
                       "doc_ids": pack(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("i8")),
                       "id_null": pack(ids.is_null().to_numpy(zero_copy_only=False)), "train": pack(flags.astype(bool)),
                       "first": pack(first), "vocabulary": pack_sorted(vocabulary), "token": pack(token.astype("u4"))}
                serial += 1
                yield pa.RecordBatch.from_pylist([row])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(train, F.lit(False)).alias("train"))
    schema = "block bigint, tokens bigint, train_tokens bigint, " + ", ".join(f"{k} binary" for k in _BLOCK)
    return stored(rows.mapInArrow(made, schema), "lm-blocks")


def triple_hashes(pairs: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Hash of (two words before, word) at every token but the first of a text; that of the first is not used."""
    out = np.zeros_like(pairs)
    out[1:] = mix(mix(pairs[:-1] ^ _U(0x452821E638D01377)) + own[1:])
    return out


class Block:
    """A block's arrays and its sorted distinct words and pairs."""

    def __init__(self, row):
        for k, dtype in _BLOCK.items():
            setattr(self, k, unpack_sorted(row[k]) if k == "vocabulary" else unpack(row[k], dtype))
        self.pair_hashes = bigram_hashes(self.vocabulary, self.token, self.first)

        self.pair, self.pair_at, self.pair_of = np.unique(self.pair_hashes, return_index=True, return_inverse=True)
        self.inner = np.ones(len(self.token), bool)  # tokens that two others (or a start and one) stand before
        self.inner[self.first[:-1]] = False

    def training(self) -> np.ndarray:
        """Which tokens belong to training texts."""
        return np.repeat(self.train, np.diff(self.first))

    def triples(self, pair_counts: np.ndarray):
        """(sorted distinct triples that can have been counted behind a pair with a state, where each first stands, tokens that
        end one, which one)."""
        seen = pair_counts[self.pair_of]
        ends = np.flatnonzero(self.inner[1:] & (seen[:-1] >= MIN_CONTEXT) & (seen[1:] > 0)) + 1
        hashes = triple_hashes(self.pair_hashes, self.vocabulary[self.token])[ends]
        triple, at, of = np.unique(hashes, return_index=True, return_inverse=True)
        return triple, ends[at], ends, of


def _cuts(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal ranges of 64-bit values begins in the sorted hashes."""
    edges = np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


_REQUEST = "range bigint, block bigint, starts bigint, kind int, hashes binary, counts binary"
WORDS, PAIRS, TRIPLES = 0, 1, 2


def _messages(block: int, starts: int, lists: dict, ranges: int) -> dict:
    """The requests of a block, by range: columns of _REQUEST. ``lists``: kind -> (sorted hashes, training counts). Ranges that
    nothing falls in get none; the count of training texts travels with one request."""
    out = {c: [] for c in ("range", "block", "starts", "kind", "hashes", "counts")}
    for kind, (hashes, counts) in lists.items():
        cut = _cuts(hashes, ranges)
        for r in np.flatnonzero(np.diff(cut)).tolist():
            part = slice(cut[r], cut[r + 1])
            for c, v in zip(out, (r, block, 0 if out["range"] else starts, kind, pack_sorted(hashes[part]), pack(counts[part]))):
                out[c].append(v)
    return out


def _request_batch(pa, columns: dict):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), kinds)], names=list(columns))


def requests(table: DataFrame, ranges: int) -> DataFrame:
    """What each block asks of each range about its words and pairs."""

    def asked(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                flags = b.training()
                counted = lambda of, n: np.bincount(of[flags], minlength=n).astype("u4")
                yield _request_batch(pa, _messages(row["block"], int(b.train.sum()), {
                    WORDS: (b.vocabulary, counted(b.token, len(b.vocabulary))), PAIRS: (b.pair, counted(b.pair_of, len(b.pair)))}, ranges))

    return table.select("block", *_BLOCK).mapInArrow(asked, _REQUEST)


def triple_requests(table: DataFrame, found: DataFrame, ranges: int) -> DataFrame:
    """What each block asks about its triples, once it knows its pairs."""

    def asked(left, right):
        import pyarrow as pa

        pairs = totals(right, PAIRS)
        out = []
        for row in left.to_pylist():
            b = Block(row)
            triple, _, ends, of = b.triples(pairs)
            counts = np.bincount(of[b.training()[ends]], minlength=len(triple)).astype("u4")
            out.append(_request_batch(pa, _messages(row["block"], 0, {TRIPLES: (triple, counts)}, ranges)))
        return pa.Table.from_batches(out)

    return _by_block(table, found.where(F.col("kind") == PAIRS)).applyInArrow(asked, _REQUEST)


def _by_block(table: DataFrame, found: DataFrame):
    return table.drop("tokens", "train_tokens").groupBy("block").cogroup(found.groupBy("block"))


def totals(answers, kind: int) -> np.ndarray:
    """The answers of a kind to a block, in the order asked."""
    import pyarrow.compute as pc

    own = answers.filter(pc.equal(answers.column("kind"), kind)).sort_by("range")
    parts = [unpack(x, np.uint64) for x in own.column("totals").to_pylist()]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _summed(hashes: list, counts: list):
    """For lists of sorted hashes with counts: each list's totals over all lists, and the distinct
    hashes with a total above 0."""
    every = np.concatenate(hashes)
    distinct, index = np.unique(every, return_inverse=True)
    total = np.bincount(index, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.uint64)
    answer = total[index]
    ends = np.cumsum([len(h) for h in hashes])
    return np.split(answer, ends[:-1]), int((total > 0).sum())


def answers(asked: DataFrame, name: str) -> DataFrame:
    """(block, range, kind, starts, distinct, totals): totals in the order of the requests. ``distinct``
    (distinct training words of the range) and ``starts`` (training texts) stand in one row each."""

    def answered(group):
        import pyarrow as pa

        kind = group.column("kind")[0].as_py()
        sums, known = _summed([unpack_sorted(x) for x in group.column("hashes").to_pylist()], [unpack(x, "u4") for x in group.column("counts").to_pylist()])
        distinct = [known if kind == WORDS and i == 0 else 0 for i in range(len(sums))]
        out = [group.column("block"), group.column("range"), group.column("kind"), group.column("starts"), pa.array(distinct, pa.int64()), pa.array([pack(t) for t in sums], pa.binary())]
        return pa.table(out, names=["block", "range", "kind", "starts", "distinct", "totals"])

    return stored(asked.groupBy("range", "kind").applyInArrow(
        answered, "block bigint, range bigint, kind int, starts bigint, distinct bigint, totals binary"), name)


class Automaton:
    """The states and arcs that a block's texts can pass through.

    States: 0 without memory, then the known words, the start of a text, and the pairs with a state. ``order``: words in a state's
    context; ``fail``, ``fail_weight``: its failure arc. Arcs: ``weight`` and ``target``; ``arc[k][i]`` is the arc by which token i
    leaves a state whose context is the k words before it, -1 where it has none (a state's context is always what stands before)."""

    def __init__(self, b: Block, words, pairs, triples, tokens: int, distinct: int, starts: int, mass: float = MASS, mass_two: float = MASS_TWO):
        self.block = b
        c, pair_counts = words.astype(np.float64), pairs.astype(np.float64)
        own, before = b.token[b.pair_at], b.token[b.pair_at - 1]  # the last word of each pair and the one before (not used at a start)
        at_start = ~b.inner[b.pair_at]
        # States.
        known = np.where(c > 0, np.cumsum(c > 0), 0)
        n_words = int((c > 0).sum())
        self.start = n_words + 1 if starts else 0
        has_state = pair_counts >= MIN_CONTEXT
        pair_state = np.where(has_state, n_words + 1 + np.cumsum(has_state), 0)
        count = np.concatenate(([0], c[c > 0], [starts], pair_counts[has_state]))
        self.order = np.concatenate(([0], np.ones(n_words + 1, np.int64), np.full(int(has_state.sum()), 2)))
        self.fail = np.concatenate((np.zeros(n_words + 2, np.int64), known[own[has_state]]))
        masses = np.where(self.order == 2, mass_two, mass)
        self.fail_weight = np.log10(masses / (count + masses))
        # Arcs of the words, of the counted pairs, of the counted triples.
        p_word = (c + 0.5) / (tokens + 0.5 * (distinct + 1))
        longest = np.where(has_state, pair_state, known[own])  # the state after a pair
        context = np.where(at_start, starts, c[before])
        p_pair = (pair_counts + mass * p_word[own]) / (context + mass)
        _, triple_at, ends, of = b.triples(pairs)
        counted = triples > 0
        pair_of = b.pair_of[triple_at]
        count_before = pair_counts[b.pair_of[triple_at - 1]]
        p_triple = (triples + mass_two * p_pair[pair_of]) / (count_before + mass_two)
        self.base = np.log10(p_word)
        self.weight = np.concatenate((self.base, np.log10(p_pair), np.log10(p_triple)))
        self.target = np.concatenate((known, longest, longest[pair_of]))
        self.arc = np.full((3, len(b.token)), -1, np.int64)
        self.arc[0] = b.token
        self.arc[1] = np.where(pairs[b.pair_of] > 0, len(c) + b.pair_of, -1)
        self.arc[2][ends] = np.where(counted[of], len(c) + len(pairs) + of, -1)

    def read(self):
        """The log10 probability of every text: all texts are read together, token by token, each with a state of its own."""
        b = self.block
        sizes = np.diff(b.first)
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = b.first[:-1][order], sizes[order]
        state, total = np.full(len(sizes), self.start), np.zeros(len(sizes))
        live = len(sizes)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes[:live], -t, side="left"))
            at, now = begin[:live] + t, state[:live]
            arc = self.arc[self.order[now], at]
            stuck = np.flatnonzero(arc < 0)
            while len(stuck):
                total[stuck] += self.fail_weight[now[stuck]]
                now[stuck] = self.fail[now[stuck]]
                arc[stuck] = self.arc[self.order[now[stuck]], at[stuck]]
                stuck = stuck[arc[stuck] < 0]
            total[:live] += self.weight[arc]
            state[:live] = self.target[arc]
        out = np.empty(len(sizes))
        out[order] = total
        return out


def scored(docs: DataFrame, train: Column, mass: float = MASS, mass_two: float = MASS_TWO) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``."""
    table = blocks(docs, train)
    size = table.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"), F.coalesce(F.sum("train_tokens"), F.lit(0)).alias("train")).first()
    ranges = max(MIN_RANGES, -(-size["all"] // RANGE_TOKENS))
    found = answers(requests(table, ranges), "lm-answers")
    more = answers(triple_requests(table, found, ranges), "lm-triples")
    sums = found.agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("v"), F.coalesce(F.sum("starts"), F.lit(0)).alias("starts")).first()
    n, distinct, starts = size["train"], sums["v"], sums["starts"]

    def score(left, right):
        import pyarrow as pa

        words, pairs, triples = (totals(right, k) for k in (WORDS, PAIRS, TRIPLES))
        out = []
        for row in left.to_pylist():
            b = Block(row)
            model = Automaton(b, words, pairs, triples, n, distinct, starts, mass, mass_two)
            cut = b.first[:-1]
            known, base = (np.add.reduceat(x, cut) for x in ((words[b.token] > 0).astype(np.int64), model.base[b.token]))
            out.append(pa.table({
                "doc_id": pa.array(b.doc_ids, pa.int64(), mask=b.id_null), "train": pa.array(b.train), "n_tokens": pa.array(np.diff(b.first)),
                "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(known), n), pa.int64()), "base_score": pa.array(base), "score": pa.array(model.read())}))
        return pa.concat_tables(out)

    schema = "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return _by_block(table, found.unionByName(more).select("block", "range", "kind", "totals")).applyInArrow(score, schema)
