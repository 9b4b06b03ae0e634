"""Words of many texts as flat numpy arrays, straight from Arrow's UTF-8 buffers.

A word is a maximal run of word bytes inside one text; A-Z count as a-z. Each word becomes a 64-bit
hash: a polynomial over per-byte random 64-bit values, finished by a bit mixer. All texts of a
block are handled by a few array operations, with no Python per word.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Word bytes where ASCII white space separates words.
NOT_SPACE = ~_SPACE
#: Word bytes where everything but digits, letters and non-ASCII separates words.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit moves every output bit)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_VALUES = mix((np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)))[_LOWER]
_BASE = _U(0xD1342543DE82EF95)
_BASE_INVERSE = _U(pow(0xD1342543DE82EF95, -1, 1 << 64))
RUN_BYTES = 1 << 18  # bytes whose words are hashed at a time: bounds the memory of a text of any length


def _powers(base):
    steps = np.full(RUN_BYTES, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_UP, _DOWN = _powers(_BASE), _powers(_BASE_INVERSE)


class Words:
    """``hashes`` of all words in order and ``first[i]:first[i + 1]``, the words of text i."""

    __slots__ = ("hashes", "first")

    def __init__(self, hashes, first):
        self.hashes, self.first = hashes, first

    def counts(self):
        return np.diff(self.first)


def word_runs(data: np.ndarray, ends: np.ndarray, word_bytes: np.ndarray):
    """``data``: the bytes of some texts in a row; ``ends``: where each text ends. Yields (hashes,
    texts) of the words in order, RUN_BYTES bytes at a time: their hashes and the texts they are in.
    A word that lies across runs is carried on and comes with the run that ends it."""
    n = len(data)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    carried = (0, 0, 0)  # polynomial, bytes and start of the word that the run before left open
    is_open = False
    for at in range(0, n, RUN_BYTES):
        part = data[at:at + RUN_BYTES]
        size = len(part)
        inside = word_bytes[part]
        cuts = starts[np.searchsorted(starts, at):np.searchsorted(starts, at + size)] - at  # texts that start here
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        begin[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[cuts[cuts > 0] - 1] = inside[cuts[cuts > 0] - 1]
        b, e = np.flatnonzero(begin), np.flatnonzero(last) + 1
        total = np.cumsum(_VALUES[part] * _UP[:size])
        sums = total[e - 1]
        sums[b > 0] -= total[b[b > 0] - 1]
        sums *= _DOWN[b]
        lengths, b = (e - b).astype(np.uint64), b + at
        if is_open:
            value, length, begun = carried
            sums[0] = _U((value + pow(int(_BASE), length, 1 << 64) * int(sums[0])) & 0xFFFFFFFFFFFFFFFF)
            lengths[0] += _U(length)
            b[0] = begun
        after = at + size
        is_open = after < n and bool(inside[-1] and word_bytes[data[after]]) and not (starts[np.searchsorted(starts, after):][:1] == after).any()
        if is_open:
            carried = (int(sums[-1]), int(lengths[-1]), int(b[-1]))
            sums, lengths, b = sums[:-1], lengths[:-1], b[:-1]
        if len(sums):
            yield mix(sums + lengths), np.searchsorted(starts, b, side="right") - 1


def words_of(data: np.ndarray, ends: np.ndarray, word_bytes: np.ndarray) -> Words:
    """All words of the texts at once."""
    runs = list(word_runs(data, ends, word_bytes))
    counts = np.zeros(len(ends), np.int64)
    for _, texts in runs:
        counts[texts[0]:texts[-1] + 1] += np.bincount(texts - texts[0])
    hashes = np.concatenate([h for h, _ in runs]) if runs else np.empty(0, np.uint64)
    return Words(hashes, np.concatenate(([0], np.cumsum(counts))).astype(np.int64))


def text_blocks(batch_column, max_bytes: int):
    """(first row, row count, bytes, ends) of runs of rows with about ``max_bytes`` bytes; a longer
    text is a run of its own, never cut. NULL counts as empty."""
    import pyarrow as pa

    col = batch_column.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, offsets, values = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        j = min(j, len(col))
        yield i, j - i, data[off[i]:off[j]], off[i + 1:j + 1] - off[i]
        i = j


def windows(words: Words, size: int):
    """Hashes of all runs of ``size`` consecutive words within a text; a text with fewer words, but
    not none, has its whole sequence as its only one. Returns (hashes, first) as in Words."""
    n = words.counts()
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.concatenate(([0], np.cumsum(per))).astype(np.int64)
    total = int(first[-1])
    if not total:
        return np.empty(0, np.uint64), first
    text = np.repeat(np.arange(len(n)), per)
    start = words.first[text] + (np.arange(total) - first[text])
    length = np.minimum(n[text], size)
    out = length.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    top = len(words.hashes) - 1
    for k in range(size):
        part = words.hashes[np.minimum(start + k, top)] + _U(k + 1)
        out = np.where(k < length, mix(out ^ part), out)
    return out, first


def hash_words(texts, word_bytes) -> list:
    """The word hashes of a few texts held in Python (queries, tests)."""
    raw = [(t or "").encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
    w = words_of(np.frombuffer(b"".join(raw), np.uint8), ends, word_bytes)
    return [w.hashes[w.first[i]:w.first[i + 1]] for i in range(len(raw))]
