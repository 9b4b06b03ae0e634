"""Operator 8, byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that can end its encoding: the token t
for which the prefix without t ends in a token that may stand before t (no merge crosses the seam
earlier than the merges that made the two). Storing that last token for each prefix gives the
encoding by walking back, lets bytes be appended exactly, and lets an edit be re-encoded only up
to where the stored tokens agree again.

The ranks file is a parameter; the driver reads it once and ships it (its size is checked). Texts are split by
the tokenizer's pattern and each match is encoded by itself. Encodings of short matches are kept in
a bounded cache per worker.

Edge cases: NULL and empty texts encode to no tokens. Very long texts and matches cost time in
proportion to their length. Repeated rows and NULL ids pass through; extra columns are kept unless
they are called ``ids`` or ``decoded``, which are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.llm.common import text_or_empty

MAX_RANKS_BYTES = 16_000_000
CACHE_ITEMS = 250_000
PAIR_ITEMS = 500_000
CACHED_CHARS = 48
ROWS_OUT = 512
_NONE = -1


class Vocabulary:
    """Ranks with the pair that makes each token, and the test whether two tokens may be neighbours."""

    def __init__(self, ranks: dict):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.longest = max(map(len, ranks))
        self.pairs, self.halves = {}, {}
        for t, r in ranks.items():
            parts = self._parts(t, r) if len(t) > 1 else [r]
            if len(parts) == 2:
                self.halves[r] = tuple(parts)
                self.pairs[tuple(parts)] = r
            elif len(parts) == 1:
                self.halves[r] = None  # a single byte
        # Tokens that merges can reach; others stand only for a whole match. The automaton finds all
        # of them that end at a byte, the longest first (bytes as Latin-1 text).
        import ahocorasick

        self._ends = ahocorasick.Automaton()
        for t, r in ranks.items():
            if r in self.halves:
                self._ends.add_word(t.decode("latin-1"), (len(t), r))
        self._ends.make_automaton()
        self._count = len(self.tokens)
        self._fits: dict = {}

    def _parts(self, token: bytes, below: int) -> list:
        """The token's bytes after all merges of a lower rank."""
        parts = [bytes([b]) for b in token]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """May ``right`` follow ``left`` in an encoding? Both are taken apart at the seam, the later
        merge first; a merge across the seam that would have come before rules the pair out."""
        if len(self._fits) >= PAIR_ITEMS:
            self._fits.clear()
        known = self._fits[left * self._count + right] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        a, b, limit = left, right, len(self.tokens)
        while True:
            across = self.pairs.get((a, b))
            if across is not None and across < limit:
                return False
            # Undo the newer of the two; of equal tokens the right one, as merges run from the left.
            if a > b:
                limit, parts = a, self.halves[a]
                if parts is None:
                    limit, parts = b + 1, self.halves[b]
                    if parts is None:
                        return True
                    b = parts[0]
                else:
                    a = parts[1]
            else:
                limit, parts = b + 1, self.halves[b]
                if parts is None:
                    limit, parts = a, self.halves[a]
                    if parts is None:
                        return True
                    a = parts[1]
                else:
                    b = parts[0]

    def extend(self, data: bytes, last: list, start: int, stop: int) -> None:
        """Fill ``last[i]`` (token that ends the prefix of i bytes) for start < i <= stop."""
        last[start + 1:stop + 1] = [_NONE] * (stop - start)
        known, count, done = self._fits.get, self._count, start
        begin = max(0, start + 1 - self.longest)
        for end, (size, t) in self._ends.iter(data[begin:stop].decode("latin-1")):
            i = begin + end + 1
            if i <= done:
                continue
            before = last[i - size] if i > size else _NONE
            if i > size:
                if before == _NONE:
                    continue
                ok = known(before * count + t)
                if not (self.fits(before, t) if ok is None else ok):
                    continue
            last[i] = t
            done = i

    def walk_back(self, last: list) -> list:
        out, i = [], len(last) - 1
        while i > 0:
            out.append(last[i])
            i -= len(self.tokens[last[i]])
        return out[::-1]

    def encode(self, piece: bytes) -> list:
        """Ids of one match of the pattern (a match that is a token is that token)."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last = [_NONE] * (len(piece) + 1)
        self.extend(piece, last, 0, len(piece))
        return self.walk_back(last)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixEncoder:
    """The encoding of one growing and changing byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [_NONE]
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self.last += [_NONE] * len(more)
        self.vocabulary.extend(self.data, self.last, start, len(self.data))

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace data[start:stop]; returns how many prefixes were looked at again."""
        old_tail = self.last[stop + 1:]
        self.data = self.data[:start] + new + self.data[stop:]
        moved = start + len(new)
        self.last = self.last[:start + 1] + [_NONE] * len(new) + old_tail
        self.vocabulary.extend(self.data, self.last, start, moved)
        # Prefixes after the edit: once as many as the longest token agree, all later ones do.
        agreed, i = 0, moved
        while i < len(self.data) and agreed < self.vocabulary.longest:
            before = self.last[i + 1]
            self.vocabulary.extend(self.data, self.last, i, i + 1)
            # A token that reaches back over the edit may be the same and yet not stand for the same bytes.
            agreed = agreed + 1 if self.last[i + 1] == before else 0
            i += 1
        return i - start

    def ids(self) -> list:
        return self.vocabulary.walk_back(self.last)


def read_ranks(path: str) -> dict:
    with open(path, "rb") as f:
        raw = f.read(MAX_RANKS_BYTES + 1)
    if len(raw) > MAX_RANKS_BYTES:
        raise ValueError(f"{path}: more than {MAX_RANKS_BYTES} bytes of ranks")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def _vocabulary(shipped, key: str):
    """(vocabulary, cache of encoded matches), one per Python worker: the last one used. They hang
    off ``sys``, which outlives a task; this module's globals travel with each task's function."""
    import sys

    opened = getattr(sys, "_tonalert_bpe", None)
    if opened is None or opened[0] != key:
        opened = sys._tonalert_bpe = (key, Vocabulary(shipped.value), {})
    return opened[1:]


class Tokenizer:
    """BPE over DataFrames. ``ranks_path``: rank file; ``pattern``: what is encoded separately."""

    def __init__(self, spark, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        self._shipped = spark.sparkContext.broadcast(ranks)
        self._key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
        self._pattern = pattern

    def encode(self, df: DataFrame, text: str = "text") -> DataFrame:
        """``df`` with ``ids``: the token ids as little-endian unsigned 32-bit integers, packed."""
        shipped, key, pattern = self._shipped, self._key, self._pattern
        keep = [c for c in df.columns if c not in ("ids", "_text")]

        def encoded(batches):
            import pyarrow as pa
            import regex

            (voc, cache), split = _vocabulary(shipped, key), regex.compile(pattern).findall

            def pack(piece):
                out = array("I", voc.encode(piece.encode())).tobytes()
                if len(piece) <= CACHED_CHARS:
                    if len(cache) >= CACHE_ITEMS:
                        cache.clear()
                    cache[piece] = out
                return out

            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_OUT):
                    part = batch.slice(at, ROWS_OUT)
                    ids = [b"".join([cache.get(p) or pack(p) for p in split(t)]) for t in part.column("_text").to_pylist()]
                    cols = [part.column(c) for c in keep]
                    yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.binary())], names=keep + ["ids"])

        source = df.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(f"`{text}`").alias("_text"))
        schema = df.select(*[F.col(f"`{c}`") for c in keep]).schema
        return source.mapInArrow(encoded, T.StructType([*schema.fields, T.StructField("ids", T.BinaryType())]))

    def decode(self, df: DataFrame) -> DataFrame:
        """``df`` with ``decoded``: the bytes that ``ids`` stand for."""
        shipped, key = self._shipped, self._key
        keep = [c for c in df.columns if c != "decoded"]

        def decoded(batches):
            import pyarrow as pa

            voc, _ = _vocabulary(shipped, key)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_OUT):
                    part = batch.slice(at, ROWS_OUT)
                    out = [voc.decode(array("I", x)) for x in part.column("ids").to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(out, pa.binary())], names=keep + ["decoded"])

        plain = df.select(*[F.col(f"`{c}`") for c in keep])
        return plain.mapInArrow(decoded, T.StructType([*plain.schema.fields, T.StructField("decoded", T.BinaryType())]))
