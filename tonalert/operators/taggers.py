"""Taggers that give raw tokens their BIO tag names.

* ``Gazetteer``: listed phrases of one word or more. Phrases are a token trie kept as a table of states: from a state a
  word leads to the next one, which may end a phrase of some kind or lead on. Matches are leftmost-longest and
  do not overlap. A match opens a span (B-), unless it follows directly on one of the same kind (I-).
* ``Hmm``: a learned linear-chain tagger. Transitions and emissions are counted from gold tags by DataFrame
  aggregations; tags are the best path (Viterbi). Scores are whole numbers (LOG_UNIT to a factor
  of ten), so that sums do not depend on the order of additions; ties go to the first tag name.

Both have two ways with the same result. A table of small measured size goes to the tasks once and each
row is tagged in one pass where it is. Beyond that rows are tagged in blocks (``lookup``): a block asks once for each of its
words, and for each run of words that can begin a phrase, and tags its rows from the answers.

A NULL token list has NULL tags, an empty one has none. NULL tokens are never listed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.functions.core import bind
from tonalert.operators import lookup as LK
from tonalert.operators.joins import measured_bytes
from tonalert.session import release_shuffles, reliable_checkpoint

TRIE_LIMIT_BYTES = 48 * 1024 * 1024  # measured bytes of a table that goes to the tasks whole (about three times that in a Python worker)
JOINED_WORDS = 8  # words of a phrase that are looked up one by one; a longer one is then compared as a whole
STATE_BLOCK = 64  # words whose states are folded together
LOG_UNIT = 1_000_000
ROOT = 0
ROW = "_tag_row"


def _listed(phrases: DataFrame, phrase: str, kind: str) -> DataFrame:
    """(w array<string>, kind, states array<bigint>): the phrases' words and the state after each of them, a hash that
    folds in word after word."""
    words = F.filter(F.split(F.col(phrase), " "), lambda w: w != "")
    rows = phrases.select(words.alias("w"), F.col(kind).alias("kind")).where((F.size("w") > 0) & F.col("kind").isNotNull())
    return rows.withColumn("states", _states("w"))


def _states(words: str) -> Column:
    """ROOT and the state after each of ``words``. They are folded by blocks: a block's states are appended word by word, the
    blocks one by one, so a phrase of many thousand words copies no long list at every word."""
    root = F.lit(ROOT).cast("bigint")

    def block(acc, b):
        own = F.slice(words, b * STATE_BLOCK + 1, F.lit(STATE_BLOCK))
        states = F.aggregate(own, F.array(acc["last"]), lambda a, w: F.concat(a, F.array(F.xxhash64(F.element_at(a, -1), w))))
        return bind(states, lambda v: F.struct(F.element_at(v, -1).alias("last"), F.concat(acc["blocks"], F.array(F.slice(v, 2, STATE_BLOCK))).alias("blocks")))

    start = F.struct(root.alias("last"), F.array(F.array(root)).alias("blocks"))
    blocks = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / STATE_BLOCK).cast("int"))
    return F.aggregate(blocks, start, block, lambda acc: F.flatten(acc["blocks"]))


def phrase_trie(phrases: DataFrame, phrase: str = "tok", kind: str = "kind") -> DataFrame:
    """The trie (n, state, word, next, kind, more): the n-th word leads from ``state`` to ``next``; ``kind`` where a
    phrase ends (the smallest on conflict), ``more`` where a longer one goes on. Words are separated by blanks."""
    # Each word's row holds that word's own step alone, so a long phrase is not copied once per word.
    step = F.transform("w", lambda w, i: F.struct(
        (i + 1).alias("n"), F.get("states", i).alias("state"), w.alias("word"), F.get("states", i + 1).alias("next"),
        F.when(i + 1 == F.size("w"), F.col("kind")).alias("kind"), (i + 1 < F.size("w")).alias("more")))
    rows = _listed(phrases, phrase, kind).select(F.explode(step).alias("s")).select("s.*")
    return rows.groupBy("n", "state", "word").agg(F.first("next").alias("next"), F.min("kind").alias("kind"), F.max("more").alias("more"))


def numbered_rows(df: DataFrame) -> DataFrame:
    """``df`` with a number of its own for each row, written once: the numbers stay as they are."""
    return reliable_checkpoint(df.withColumn(ROW, F.monotonically_increasing_id()))


class Gazetteer:
    """Tags from listed phrases (``phrase``, ``kind``); runs jobs that write the list and measure it. The names of the kinds are
    sent to the driver."""

    def __init__(self, phrases: DataFrame, phrase: str = "tok", kind: str = "kind", limit: int = TRIE_LIMIT_BYTES):
        self.phrases = reliable_checkpoint(phrases.select(F.col(phrase).alias("tok"), F.col(kind).alias("kind")))  # read several times
        release_shuffles(phrases.sparkSession)
        self.small = False
        if measured_bytes(self.phrases) <= limit:  # the trie's rows are more than the phrases
            self.trie = reliable_checkpoint(phrase_trie(self.phrases))
            self.small = measured_bytes(self.trie) <= limit

    def tag(self, df: DataFrame, tokens: str = "tokens", col: str = "tags") -> DataFrame:
        """``df`` with ``col``, one tag name per token."""
        return df.withColumn(col, self._in_place(df)(F.col(tokens))) if self.small else self._looked_up(df, tokens, col)

    def _in_place(self, df: DataFrame) -> Callable:
        rows = self.trie.select("state", "word", "next", "kind", "more").collect()  # measured above
        trie = df.sparkSession.sparkContext.broadcast({(r["state"], r["word"]): (r["next"], r["kind"], r["more"]) for r in rows})
        return F.arrow_udf(lambda lists: _tag_lists(lists, trie.value), "array<string>")

    def _looked_up(self, df: DataFrame, tokens: str, col: str) -> DataFrame:
        blocks = LK.token_blocks(df, tokens)
        bits = LK.range_bits(blocks)
        kinds = sorted(r["kind"] for r in self.phrases.where("kind IS NOT NULL").select("kind").distinct().collect())
        # Words of the longest phrase, or more where blanks stand together.
        blanks = self.phrases.agg(F.max(F.char_length("tok") - F.char_length(F.replace("tok", F.lit(" "), F.lit(""))))).first()[0] or 0
        levels, number = min(blanks + 1, JOINED_WORDS), {k: i + 1 for i, k in enumerate(kinds)}
        table = LK.entries(self.phrases, lambda batch: _phrase_entries(batch, number, levels), 1, bits)
        # Words are all asked for, runs of words only where the filter lets them pass.
        own = LK.entry_filter(table, bits) if levels > 1 else None
        shared = df.sparkSession.sparkContext.broadcast((own.data, own.bits)) if own else None  # bounded by LK.FILTER_BITS

        def runs(block):
            return list(_runs(block, LK.Filter(*shared.value), levels)) if shared else []

        def asks(block):
            return _asked(block, runs(block))

        def tags(block, hit, values, extra):
            return _tags_of_runs(block, runs(block), levels, hit, values, extra, kinds)

        found = LK.answered(LK.asked(blocks, asks, bits), table, 1)
        return LK.finished(df, tokens, col, T.ArrayType(T.StringType()), blocks, found, 1, tags)


_PLACE = 0x9E3779B97F4A7C15


def _places(starts, sizes):
    """The places from each start on, as many as its size."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _whole_hash(words, sizes):
    """Hashes of whole runs of words, whose hashes follow one another."""
    starts = np.cumsum(sizes) - sizes
    place = (np.arange(len(words)) - np.repeat(starts, sizes) + 1).astype(np.uint64) * np.uint64(_PLACE)
    return np.add.reduceat(LK.mix(words + place), starts) if len(sizes) else np.empty(0, np.uint64)


def _phrase_entries(batch, number: dict, levels: int):
    """Of a batch of (phrase, kind): the hash of every run of up to ``levels`` words that a phrase begins with, with its kind's number if
    it is a phrase, else 0; of longer phrases (that hash, words, hash of all, kind)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.split_pattern(batch.column(0).cast(pa.string()), " ")
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    some = np.array([w != "" for w in coded.dictionary.to_pylist()], bool)[code]
    words = LK.word_hashes(coded.dictionary)[code[some]]
    before = np.append(0, np.cumsum(some))
    ends = before[np.cumsum(sizes)]
    starts = before[np.cumsum(sizes) - sizes]
    kind = np.array([number.get(k, 0) for k in batch.column(1).cast(pa.string()).to_pylist()], np.int64)
    listed = (ends > starts) & (kind > 0)
    at, n, kind = starts[listed], (ends - starts)[listed], kind[listed]
    state, hashes, values = words[at], [], []
    extra = np.empty((0, LK.EXTRA), np.uint64)
    for k in range(1, levels + 1):
        hashes.append(state)
        values.append(np.where(n == k, kind, 0))
        on = n > k
        at, n, kind, state = at[on], n[on], kind[on], state[on]
        if k < levels:
            state = LK.longer(state, words[at + k])
        elif len(at):
            extra = np.stack([state, n.astype(np.uint64), _whole_hash(words[_places(at, n)], n), kind.astype(np.uint64)], axis=1)
    return np.concatenate(hashes), np.concatenate(values).reshape(-1, 1), extra


def _runs(block, passes, levels: int):
    """(n, places, hashes): the runs of n words, from two on, that can begin a phrase."""
    known = block.codes < len(block.hashes)
    word = np.append(block.hashes, np.uint64(0))[block.codes]
    ends = np.repeat(np.cumsum(block.sizes), block.sizes)
    at = np.flatnonzero(np.append(passes(block.hashes), False)[block.codes])
    state = word[at]
    for n in range(2, levels + 1):
        on = (at + n - 1 < ends[at])
        on[on] = known[at[on] + n - 1]
        at = at[on]
        state = LK.longer(state[on], word[at + n - 1])
        on = passes(state)
        at, state = at[on], state[on]
        if not len(at):
            return
        yield n, at, state


def _asked(block, runs: list):
    return LK.distinct(np.concatenate([block.hashes, *[state for _, _, state in runs]]))


def _tags_of_runs(block, runs: list, levels: int, hit, values, extra, kinds: list):
    """The tags of a block's tokens: the longest phrase at each place that has one, from the left, without overlaps."""
    import pyarrow as pa

    asked = _asked(block, runs)
    number = np.zeros(len(asked), np.int64)
    number[np.flatnonzero(hit)] = values[:, 0]
    kind = np.append(number[np.searchsorted(asked, block.hashes)], 0)[block.codes]
    size = (kind > 0).astype(np.int64)
    for n, at, state in runs:
        own = number[np.searchsorted(asked, state)]
        at, own = at[own > 0], own[own > 0]
        kind[at], size[at] = own, n
    if len(extra) and runs and runs[-1][0] == levels:
        _longer_phrases(block, runs[-1][1], runs[-1][2], extra, kind, size)
    # Only phrases of several words take places away from others: they are walked from the left.
    several, busy, kept = np.flatnonzero(size > 1), 0, []
    for p, end in zip(several.tolist(), (several + size[several]).tolist()):
        if p >= busy:
            kept.append(p)
            busy = end
    kept = np.array(kept, np.int64)
    free = size == 1
    free[_places(kept, size[kept])] = False
    free[kept] = True
    taken = np.flatnonzero(free)
    n, kind = size[taken], kind[taken]
    row = np.repeat(np.arange(len(block.sizes)), block.sizes)[taken]
    follows = np.zeros(len(taken), bool)
    follows[1:] = (taken[1:] == taken[:-1] + n[:-1]) & (row[1:] == row[:-1]) & (kind[1:] == kind[:-1])
    out = np.zeros(len(block.codes), np.int32)
    out[_places(taken, n)] = np.repeat(kind + len(kinds), n)
    out[taken[~follows]] = kind[~follows]
    names = pa.array(["O", *[f"B-{k}" for k in kinds], *[f"I-{k}" for k in kinds]], pa.string())
    return block.lists(names.take(pa.array(out)))


def _longer_phrases(block, places, states, extra, kind, size) -> None:
    """Phrases of more words than are looked up, at the places where as many of their words stand: the whole run is compared."""
    word = np.append(block.hashes, np.uint64(0))[block.codes]
    missing = np.append(0, np.cumsum(block.codes == len(block.hashes)))
    ends = np.repeat(np.cumsum(block.sizes), block.sizes)
    order = np.argsort(states, kind="stable")
    places, states = places[order], states[order]
    seen = {}  # hashes of the runs at a place
    for state, n, whole, k in np.unique(extra, axis=0):
        n, k = int(n), int(k)
        for p in places[np.searchsorted(states, state):np.searchsorted(states, state, side="right")].tolist():
            if p + n > ends[p] or n < size[p] or missing[p + n] > missing[p]:
                continue
            if (p, n) not in seen:
                seen[p, n] = _whole_hash(word[p:p + n], np.array([n]))[0]
            if seen[p, n] == whole and (n > size[p] or k < kind[p]):
                kind[p], size[p] = k, n


def _tag_lists(lists, trie: dict):
    """Tags of a batch of token lists, in one pass over the tokens of each. Equal tokens are looked up once."""
    import pyarrow as pa

    lists = lists.cast(pa.list_(pa.string()))
    offsets = lists.offsets.to_numpy()
    first, last = int(offsets[0]), int(offsets[-1])
    values = lists.values.slice(first, last - first)
    coded = values.dictionary_encode()
    words = coded.dictionary.to_pylist()
    code = coded.indices.fill_null(len(words)).to_numpy(zero_copy_only=False)
    start = [trie.get((ROOT, w)) for w in words] + [None]
    begins = np.array([s is not None for s in start])
    names, number = ["O"], {}

    def named(mark, kind):
        if (mark, kind) not in number:
            number[mark, kind] = len(names)
            names.append(f"{mark}-{kind}")
        return number[mark, kind]

    out = np.zeros(len(code), np.int32)
    ends = offsets[1:] - first
    places = np.flatnonzero(begins[code])
    rows = np.searchsorted(ends, places, side="right")
    busy, before = 0, None  # end and kind of the match before
    for p, row in zip(places.tolist(), rows.tolist()):
        if p < busy:
            continue
        stop, size, k = int(ends[row]), 1, 1
        state, kind, more = start[code[p]]
        while more and p + k < stop and code[p + k] < len(words):
            state, longer, more = trie.get((state, words[code[p + k]]), (None, None, False))
            k += 1
            if longer is not None:
                kind, size = longer, k
        if kind is None:
            continue
        follows = busy == p and before == (row, kind)
        out[p] = named("I" if follows else "B", kind)
        if size > 1:
            out[p + 1:p + size] = named("I", kind)
        busy, before = p + size, (row, kind)
    tags = pa.array(names).take(pa.array(out))
    return pa.ListArray.from_arrays(pa.array(offsets - first, pa.int32()), tags, mask=lists.is_null() if lists.null_count else None)


START = ""
COUNTED_TOKENS = 2_000_000  # tokens that a task counts at a time


def _tag_counts(batches):
    """Of batches of (tokens, tags): how often a word has a tag (word, NULL, tag, n) and a tag follows another one or the
    start of a row (NULL, before, tag, n)."""
    import pyarrow as pa

    for batch in batches:
        toks, tags = (batch.column(i).cast(pa.list_(pa.string())) for i in (0, 1))
        sizes = [x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("int64") for x in (toks, tags)]
        ends, a = sizes[0].cumsum(), 0
        while a < len(toks):
            b = max(a + 1, int(ends.searchsorted((ends[a - 1] if a else 0) + COUNTED_TOKENS, side="right")))
            yield _counted_tags(toks.slice(a, b - a), tags.slice(a, b - a), sizes[0][a:b], sizes[1][a:b])
            a = b


def _counted_tags(toks, tags, n_toks, n_tags):
    import pyarrow as pa

    def coded(lists):
        values = lists.flatten().dictionary_encode()
        return values.dictionary, values.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    (words, word), (names, name) = coded(toks), coded(tags)
    n = np.minimum(n_toks, n_tags)  # a token without a tag, or the other way round, is not counted
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    word = word[np.repeat(np.cumsum(n_toks) - n_toks, n) + at]
    of = np.repeat(np.cumsum(n_tags) - n_tags, n) + at
    tag = name[of]
    k = len(names)  # the number of a row's start
    before = np.where(at == 0, k, name[np.maximum(of - 1, 0)]) if len(name) else tag
    known = (word >= 0) & (tag >= 0)

    def summed(left, right):
        cell, many = np.unique(left * k + right, return_counts=True) if k else (left[:0], left[:0])
        return cell // max(k, 1), names.take(pa.array(cell % max(k, 1))), many

    w, t, m = summed(word[known], tag[known])
    chained = known & (before >= 0)
    b, u, c = summed(before[chained], tag[chained])
    starts = pa.concat_arrays([names, pa.array([START], pa.string())])
    columns = [pa.concat_arrays([words.take(pa.array(w)), pa.nulls(len(b), pa.string())]),
               pa.concat_arrays([pa.nulls(len(w), pa.string()), starts.take(pa.array(b))]),
               pa.concat_arrays([t, u]), pa.array(np.append(m, c), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "before", "tag", "n"])


class Hmm:
    """A linear-chain tagger learned from gold tags. ``tags``: the tag names in order; ``steps``: scores of one tag
    after another, the last row those of a first tag; ``emissions``: (word, scores array<bigint>) of every
    known word, ``unknown``: the scores of any other."""

    def __init__(self, tags: list[str], steps: list[list[int]], emissions: DataFrame, unknown: list[int], limit: int = TRIE_LIMIT_BYTES):
        self.tags, self.steps, self.emissions, self.unknown = tags, steps, emissions, unknown
        self.small = measured_bytes(emissions) <= limit

    @classmethod
    def fit(cls, df: DataFrame, tokens: str = "tokens", tags: str = "tags", alpha: float = 1.0, limit: int = TRIE_LIMIT_BYTES) -> Hmm:
        """Counts over all rows, smoothed by ``alpha``. Sent to the driver: the tag names, their counts and the counts of
        their pairs, whose number depends on the tag set only. A token without a tag, or the other way round, is not counted."""
        # Added up in the tasks, in one pass over the rows: what is shuffled are sums by word and tag and by pairs of tags.
        sums = df.select(F.col(tokens).cast("array<string>"), F.col(tags).cast("array<string>")).mapInArrow(_tag_counts, "word string, before string, tag string, n bigint")
        sums = reliable_checkpoint(sums.groupBy("word", "before", "tag").agg(F.sum("n").alias("n")))
        release_shuffles(df.sparkSession)
        counts = sums.where("word IS NOT NULL").select("word", "tag", "n")
        chain = {(r["before"], r["tag"]): r["n"] for r in sums.where("word IS NULL").select("before", "tag", "n").collect()}
        total = {r["tag"]: r["n"] for r in counts.groupBy("tag").agg(F.sum("n").alias("n")).collect()}
        names = sorted(total)
        words = counts.select("word").distinct().count()

        def score(n, of, kinds):
            return F.round(LOG_UNIT * F.log10((n + F.lit(alpha)) / (F.lit(float(of)) + alpha * kinds))).cast("bigint")

        emissions = counts.groupBy("word").agg(F.array(*[
            score(F.coalesce(F.sum(F.when(F.col("tag") == t, F.col("n"))), F.lit(0)), total[t], words + 1) for t in names]).alias("scores")) if names else (
            counts.select("word", F.array().cast("array<bigint>").alias("scores")))
        out_of = {b: sum(chain.get((b, t), 0) for t in names) for b in [*names, START]}
        one = df.sparkSession.range(1)  # the same arithmetic for every score
        row = one.select(*[score(F.lit(chain.get((b, t), 0)), out_of[b], len(names)) for b in [*names, START] for t in names],
                         *[score(F.lit(0), total[t], words + 1) for t in names]).first() if names else []
        k = len(names)
        steps = [list(row[i * k:(i + 1) * k]) for i in range(k + 1)]
        emissions = reliable_checkpoint(emissions)
        release_shuffles(df.sparkSession)
        return cls(names, steps, emissions, list(row[k * (k + 1):]), limit)

    def tag(self, df: DataFrame, tokens: str = "tokens", col: str = "tags") -> DataFrame:
        """``df`` with ``col``: the best path's tag names."""
        tags, steps, unknown = self.tags, self.steps, self.unknown
        if not tags:
            return df.withColumn(col, F.transform(tokens, lambda w: F.lit("O")))
        if self.small:
            rows = self.emissions.collect()  # measured
            known = df.sparkSession.sparkContext.broadcast({r["word"]: r["scores"] for r in rows})
            path = F.arrow_udf(lambda lists: _best_paths(lists, known.value, tags, steps, unknown), "array<string>")
            return df.withColumn(col, path(F.col(tokens)))
        blocks = LK.token_blocks(df, tokens)
        bits, k = LK.range_bits(blocks), len(tags)
        table = LK.entries(self.emissions.where("word IS NOT NULL").select("word", "scores"), lambda batch: _emission_entries(batch, k), k, bits)
        found = LK.answered(LK.asked(blocks, lambda block: LK.distinct(block.hashes), bits), table, k)

        def path(block, hit, values, extra):
            import pyarrow as pa

            asked, place = np.unique(block.hashes, return_inverse=True)
            scores = np.tile(np.array(unknown, np.int64), (len(asked) + 1, 1))
            scores[np.flatnonzero(hit)] = values
            code = np.append(place, len(asked))[block.codes]  # NULL tokens are unknown
            return _paths(block.sizes, lambda i, j, a, b: scores[code[a:b]], tags, steps, pa.array(block.lengths < 0))

        return LK.finished(df, tokens, col, T.ArrayType(T.StringType()), blocks, found, k, path)


def _emission_entries(batch, k: int):
    scores = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, k)
    return LK.word_hashes(batch.column(0)), scores, np.empty((0, LK.EXTRA), np.uint64)


VITERBI_TOKENS = 500_000  # tokens whose scores are held at a time; a longer row is one such piece


def _viterbi(sizes, scores, steps):
    """Tag numbers of the best paths of rows of ``sizes`` tokens, whose emission scores follow one another in ``scores``
    (tokens, tags). All rows go forward together, longest first; ties go to the smaller number."""
    order = np.argsort(-sizes, kind="stable")
    sizes, starts = sizes[order], (np.cumsum(sizes) - sizes)[order]
    step, out = np.array(steps[:-1], np.int64).T.copy(), np.empty(len(scores), np.int64)  # (tag, before)
    back = np.empty(scores.shape, np.int16)
    live = int(np.count_nonzero(sizes))
    best, last = np.zeros((len(sizes), scores.shape[1]), np.int64), int(sizes[0]) if len(sizes) else 0
    for t in range(last):
        live = int(np.searchsorted(-sizes[:live], -t, side="left"))
        at = starts[:live] + t
        if t == 0:
            best[:live] = np.array(steps[-1], np.int64) + scores[at]
            continue
        ways = best[:live, None, :] + step  # (row, tag, before)
        chosen = ways.argmax(axis=2)
        back[at] = chosen
        best[:live] = np.take_along_axis(ways, chosen[:, :, None], 2)[:, :, 0] + scores[at]
    tag = best.argmax(axis=1)
    for t in range(last - 1, -1, -1):
        live = int(np.searchsorted(-sizes, -t, side="left"))
        at = starts[:live] + t
        out[at] = tag[:live]
        if t:
            tag[:live] = back[at, tag[:live]]
    return out


def _paths(sizes, scores_of, tags, steps, missing):
    """Tag lists of rows of ``sizes`` tokens; ``scores_of(first, last, first token, last token)`` gives a piece's scores."""
    import pyarrow as pa

    ends = np.cumsum(sizes)
    out, i = [], 0
    while i < len(sizes):
        begun = int(ends[i] - sizes[i])
        j = max(i + 1, int(np.searchsorted(ends, begun + VITERBI_TOKENS, side="right")))
        out.append(_viterbi(sizes[i:j], scores_of(i, j, begun, int(ends[j - 1])), steps))
        i = j
    chosen = np.concatenate(out) if out else np.empty(0, np.int64)
    offsets = pa.array(np.append(0, ends), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(tags).take(pa.array(chosen)), mask=missing if missing is not None and missing.true_count else None)


def _best_paths(lists, known, tags, steps, unknown):
    import pyarrow as pa

    lists = lists.cast(pa.list_(pa.string()))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    code = coded.indices.fill_null(len(words)).to_numpy(zero_copy_only=False)
    scores = np.array([known.get(w, unknown) for w in words] + [unknown], np.int64)
    return _paths(sizes, lambda i, j, a, b: scores[code[a:b]], tags, steps, lists.is_null())
