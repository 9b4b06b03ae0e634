"""Lookup of the tokens of many rows in a table of entries that is too large for a task (E9's taggers).

Rows become blocks of about BLOCK_TOKENS tokens, written once (``token_blocks``): a block's distinct words, a number per token and the rows'
other columns. A block asks for 64-bit hashes, of its words or of runs of them, each once (``asked``); entries are (hash, whole
numbers) in ranges of hashes (``entries``). Asks and entries of a range meet, and each block gets its answers in the order asked, so
they carry no keys (``answered``). At last every block meets its answers and gives its rows (``finished``). What is shuffled are a few bytes
for each word or run that differs within a block, and the blocks once; tasks hold a block, or a range's asks and entries. A frequent
word is one ask per block, so ranges stay even.

Words are compared by 64-bit hashes, so results are exact up to hash collisions. NULL and repeated keys do no harm: rows stay in their block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.session import release_shuffles, reliable_checkpoint

BLOCK_TOKENS = 1_200_000
RANGE_TOKENS = 2_000_000  # tokens of all rows for each range of hashes
MIN_RANGE_BITS = 4
HELD_ENTRIES = 2_000_000  # entries that a task gathers before it sends them on
FILTER_BITS = 28  # a filter's bits at most (32 MB, sent to the tasks): beyond 2 ** 24 entries more asks pass that have no answer
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit moves every output bit)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(words) -> np.ndarray:
    """64-bit hashes of an Arrow array of texts."""
    import pandas as pd

    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The different ones, sorted."""
    hashes = np.sort(hashes)
    return hashes[np.append(True, hashes[1:] != hashes[:-1])] if len(hashes) else hashes


def longer(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes of runs of words, each with one word more; a run of one word has the word's hash."""
    return mix(mix(state) + word)


def pack(values: np.ndarray) -> bytes:
    """Numbers, compressed with like bytes side by side."""
    import pyarrow as pa

    width = values.dtype.itemsize
    raw = np.ascontiguousarray(np.ascontiguousarray(values).reshape(-1).view(np.uint8).reshape(-1, width).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpack(data: bytes, dtype) -> np.ndarray:
    import pyarrow as pa

    raw = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def pack_sorted(hashes: np.ndarray) -> bytes:
    return pack(np.diff(hashes, prepend=_U(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, _U), dtype=_U)


def _to_ipc(batch) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes):
    import pyarrow as pa

    return pa.ipc.open_stream(data).read_next_batch()


def pieces(sizes: np.ndarray, most: int):
    """(first, end) of runs of rows with about ``most`` tokens; a longer row is a run of its own."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(ends.searchsorted((ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


_BLOCK = "block bigint, tokens bigint, rest binary, sizes binary, words binary, codes binary"


def token_blocks(df: DataFrame, tokens: str) -> DataFrame:
    """The rows of ``df`` as a table of blocks: one pass over them."""

    def made(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            lists = batch.column(0).cast(pa.list_(pa.string()))
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            missing = lists.is_null().to_numpy(zero_copy_only=False)
            for a, b in pieces(sizes, BLOCK_TOKENS):
                coded = lists.slice(a, b - a).flatten().dictionary_encode()
                codes = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
                row = {"block": serial, "tokens": len(codes), "rest": _to_ipc(batch.slice(a, b - a).select(range(1, batch.num_columns))),
                       "sizes": pack(np.where(missing[a:b], -1, sizes[a:b]).astype("i4")),
                       "words": _to_ipc(pa.RecordBatch.from_arrays([coded.dictionary], ["w"])), "codes": pack(codes.astype("u4"))}
                serial += 1
                yield pa.RecordBatch.from_pylist([row], schema)

    import pyarrow as pa

    schema = pa.schema([("block", pa.int64()), ("tokens", pa.int64()), *[(c, pa.binary()) for c in ("rest", "sizes", "words", "codes")]])
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns) if c != tokens]
    return reliable_checkpoint(df.select(F.col(f"`{tokens}`").cast("array<string>").alias("tokens"), F.lit(0).alias("any"), *rest).mapInArrow(made, _BLOCK))


class Block:
    """A block's words with their hashes, the number of each token's word (that of no word: a NULL token), and its rows."""

    def __init__(self, row: dict):
        self.words = _from_ipc(row["words"]).column(0)
        self.hashes = word_hashes(self.words)
        self.codes = unpack(row["codes"], "u4").astype(np.int64)
        self.lengths = unpack(row["sizes"], "i4").astype(np.int64)  # -1: a NULL list
        self.sizes = np.maximum(self.lengths, 0)
        self._rest = row.get("rest")

    def rows(self):
        """The other columns."""
        return _from_ipc(self._rest)

    def tokens(self):
        import pyarrow as pa

        return self.lists(self.words.take(pa.array(np.where(self.codes < len(self.words), self.codes, 0), mask=self.codes == len(self.words))))

    def lists(self, values):
        """A value per token as a list per row, NULL where the row's tokens are."""
        import pyarrow as pa

        missing = self.lengths < 0
        offsets = pa.array(np.append(0, np.cumsum(self.sizes)), pa.int32())
        return pa.ListArray.from_arrays(offsets, values, mask=pa.array(missing) if missing.any() else None)


class Filter:
    """Tells of most hashes that no entry has that they have none: a bit for each range of hashes."""

    def __init__(self, data: bytes, bits: int):
        self.data, self.bits = data, bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> _U(64 - self.bits)
        return (np.frombuffer(self.data, np.uint8)[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def range_bits(blocks: DataFrame) -> int:
    """2 to the power of this is the number of ranges, by the number of tokens."""
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    return max(MIN_RANGE_BITS, (tokens // RANGE_TOKENS).bit_length())


def _ranged(hashes: np.ndarray, bits: int):
    """(range, slice) of sorted hashes."""
    cut = np.append(np.searchsorted(hashes, np.arange(1 << bits, dtype=_U) << _U(64 - bits)), len(hashes))
    for r in np.flatnonzero(np.diff(cut)).tolist():
        yield r, slice(int(cut[r]), int(cut[r + 1]))


def _first_of_each(hashes: np.ndarray, values: np.ndarray):
    """Sorted distinct hashes with their values: the smallest but 0 where there is one number each, else any."""
    order = np.lexsort((np.where(values[:, 0] == 0, np.iinfo(np.int64).max, values[:, 0]), hashes)) if values.shape[1] == 1 else np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
    return hashes[first], values[order[first]]


_ENTRIES = "range bigint, n bigint, hashes binary, vals binary, extra binary"
EXTRA = 4  # numbers of an extra entry; the first is the hash that it belongs to


def _entry_batch(rows: list):
    import pyarrow as pa

    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["range", "n", "hashes", "vals", "extra"])


def _by_range(hashes, values, extra, bits: int) -> list:
    hashes, values = _first_of_each(hashes, values)
    extra = extra[np.argsort(extra[:, 0], kind="stable")]
    own = dict(_ranged(extra[:, 0], bits))
    return [(r, p.stop - p.start, pack_sorted(hashes[p]), pack(values[p]), pack(extra[own[r]] if r in own else extra[:0])) for r, p in _ranged(hashes, bits)]


def entries(df: DataFrame, read: Callable, width: int, bits: int) -> DataFrame:
    """A table with a row per range of hashes. ``read``: an Arrow batch of ``df`` -> (hashes, values (n, width), extra (m, EXTRA)); an extra
    entry's hash is among the hashes. Of a hash with several entries of one number the smallest but 0 counts."""

    def gathered(batches):
        held, n = [], 0
        for batch in batches:
            held.append(read(batch))
            n += len(held[-1][0])
            if n >= HELD_ENTRIES:
                yield _entry_batch(_by_range(*map(np.concatenate, zip(*held)), bits))
                held, n = [], 0
        if n:
            yield _entry_batch(_by_range(*map(np.concatenate, zip(*held)), bits))

    def merged(group):
        import pyarrow as pa

        parts = group.to_pylist()
        hashes, values = _first_of_each(np.concatenate([unpack_sorted(p["hashes"]) for p in parts]),
                                        np.concatenate([unpack(p["vals"], np.int64).reshape(-1, width) for p in parts]))
        extra = np.concatenate([unpack(p["extra"], _U).reshape(-1, EXTRA) for p in parts])
        extra = extra[np.argsort(extra[:, 0], kind="stable")]
        return pa.Table.from_batches([_entry_batch([(parts[0]["range"], len(hashes), pack_sorted(hashes), pack(values), pack(extra))])])

    out = reliable_checkpoint(df.mapInArrow(gathered, _ENTRIES).groupBy("range").applyInArrow(merged, _ENTRIES))
    release_shuffles(df.sparkSession)
    return out


def entry_filter(table: DataFrame, bits: int) -> Filter:
    """The filter of a table of entries. Sent to the driver: its bits, 16 for each entry and 2 ** FILTER_BITS at most."""
    n = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = max(bits + 3, min(FILTER_BITS, (16 * n).bit_length()))
    own = size - bits  # bits of a range's part

    def parts(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                flags = np.zeros(1 << own, np.uint8)
                flags[(unpack_sorted(row["hashes"]) >> _U(64 - size)) & _U((1 << own) - 1)] = 1
                yield pa.RecordBatch.from_pylist([{"range": row["range"], "part": pack(np.packbits(flags, bitorder="little"))}])

    data = bytearray(1 << (size - 3))
    step = 1 << (own - 3)
    for row in table.select("range", "hashes").mapInArrow(parts, "range bigint, part binary").collect():
        data[row["range"] * step:(row["range"] + 1) * step] = unpack(bytes(row["part"]), np.uint8).tobytes()
    return Filter(bytes(data), size)


def asked(blocks: DataFrame, hashes_of: Callable, bits: int) -> DataFrame:
    """What each block asks of each range. ``hashes_of``: Block -> sorted distinct hashes."""

    def ask(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                hashes = hashes_of(Block(row))
                parts = [(row["block"], r, pack_sorted(hashes[p])) for r, p in _ranged(hashes, bits)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in parts], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                                                 names=["block", "range", "hashes"])

    return blocks.select("block", "sizes", "words", "codes").mapInArrow(ask, "block bigint, range bigint, hashes binary")


def answered(asks: DataFrame, table: DataFrame, width: int) -> DataFrame:
    """The answers to the blocks: which hashes have an entry, the different values of these and which of them each has, and the extra
    entries of all hashes asked."""

    def answer(left, right):
        import pyarrow as pa

        out = {c: [] for c in ("block", "range", "hit", "vals", "which", "extra")}
        rows = right.to_pylist()
        known, values, extra = np.empty(0, _U), np.empty((0, width), np.int64), np.empty((0, EXTRA), _U)
        if rows:
            known, values = unpack_sorted(rows[0]["hashes"]), unpack(rows[0]["vals"], np.int64).reshape(-1, width)
            extra = unpack(rows[0]["extra"], _U).reshape(-1, EXTRA)
        values, of = np.unique(values, axis=0, return_inverse=True) if width > 1 else (values, np.arange(len(values)))
        of = of.reshape(-1)
        for row in left.to_pylist():
            hashes = unpack_sorted(row["hashes"])
            at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
            more = extra[np.isin(extra[:, 0], hashes)] if len(extra) else extra
            some, which = np.unique(of[at[hit]], return_inverse=True) if width > 1 else np.unique(values[at[hit]], return_inverse=True)
            sent = values[some] if width > 1 else some
            for c, v in zip(out, (row["block"], row["range"], pack(hit), pack(sent), pack(which.reshape(-1).astype("u4")), pack(more))):
                out[c].append(v)
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    schema = "block bigint, range bigint, hit binary, vals binary, which binary, extra binary"
    out = reliable_checkpoint(asks.groupBy("range").cogroup(table.groupBy("range")).applyInArrow(answer, schema))
    release_shuffles(table.sparkSession)
    return out


def finished(df: DataFrame, tokens: str, col: str, kind: T.DataType, blocks: DataFrame, answers: DataFrame, width: int, values_of: Callable) -> DataFrame:
    """``df`` with ``col`` of type ``kind``. ``values_of``: Block, which of the hashes asked have an entry, their values, extra entries ->
    an Arrow array, a value for each row."""
    fields = [f for f in df.schema.fields if f.name != col]
    names = [f.name for f in fields if f.name != tokens]
    schema = T.StructType([T.StructField(f.name, T.ArrayType(T.StringType()) if f.name == tokens else f.dataType) for f in fields] + [T.StructField(col, kind)])

    def finish(left, right):
        import pyarrow as pa

        parts = right.sort_by("range").to_pylist()
        hit = np.concatenate([unpack(p["hit"], bool) for p in parts]) if parts else np.empty(0, bool)
        values = np.concatenate([unpack(p["vals"], np.int64).reshape(-1, width)[unpack(p["which"], "u4")] for p in parts]) if parts else np.empty((0, width), np.int64)
        extra = np.concatenate([unpack(p["extra"], _U) for p in parts]).reshape(-1, EXTRA) if parts else np.empty((0, EXTRA), _U)
        block = Block(left.to_pylist()[0])
        rest = block.rows()
        out = {n: rest.column(i) for n, i in zip(names, kept)}
        out[tokens] = block.tokens()
        out[col] = values_of(block, hit, values, extra)
        return pa.table([out[f.name] for f in schema.fields], names=schema.names)

    others = [c for c in df.columns if c != tokens]
    kept = [1 + others.index(n) for n in names]
    return blocks.drop("tokens").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, schema)
