"""Operator 3, quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled texts. A text is compressed
piece by piece (CHUNK bytes, all of it) with each; pieces are short, so that the dictionaries and
not the text's own earlier parts explain it. The score is a logistic calibration of the normalised
difference of the two compressed sizes, with the compressed size per byte beside it (texts that
repeat themselves are short under both dictionaries). Dictionaries and calibration are
fitted on different halves of a sample of at most SAMPLE_ROWS labelled rows per class, of long texts on
pieces of SAMPLE_BYTES in all; whole texts are scored.

Edge cases: NULL and empty texts have difference 0 and size 1 per byte and get the score of that;
with labels of one class only (or none) every score is that class's share (0.5 without labels).
Repeated rows and NULL ids are scored like others. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalert.llm.training import Logistic, labelled_sample

SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
DICTIONARY_ROWS = 1_000  # labelled texts per dictionary
CHUNK = 256
LEVEL = 3


def pieces(data: bytes) -> list:
    return [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]


def dictionary(texts: list) -> bytes:
    """A dictionary of the texts' pieces: trained, or their plain bytes where there are too few."""
    import zstandard

    samples = [p for t in texts for p in pieces(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self._size = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self._size.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def inputs(self, data: bytes) -> list:
        if not data:
            return [0.0, 0.0, 1.0, 1.0, 0.0]
        cut = pieces(data)
        good, bad = (sum(len(size(p)) for p in cut) for size in self._size)
        diff, rate = (good - bad) / min(good, bad), good / len(data)
        return [diff, diff * diff, rate, rate * rate, diff * rate]


def fit(sample: list):
    """``sample``: (text bytes, label). Returns (good dictionary, bad dictionary, calibration), or the
    constant score where a class is missing."""
    by = {y: [t for t, z in sample if z == y] for y in (0, 1)}
    if min(len(by[0]), len(by[1])) < 2:
        return len(by[1]) / len(sample) if sample else 0.5
    half = {y: min(DICTIONARY_ROWS, len(by[y]) // 2) for y in by}
    good, bad = dictionary(by[1][:half[1]]), dictionary(by[0][:half[0]])
    sizes = Sizes(good, bad)
    rest = [(t, y) for y in by for t in by[y][half[y]:]]
    # Both classes weigh as much: the cut at 0.5 is then between them whatever their shares.
    n = {y: len(by[y]) - half[y] for y in by}
    return good, bad, Logistic([sizes.inputs(t) for t, _ in rest], [y for _, y in rest], np.array([len(rest) / (2 * n[y]) for _, y in rest]))


def scored(docs: DataFrame, labels: DataFrame, allowed: Column) -> DataFrame:
    """doc_id, score of every text; labels are read from the ``allowed`` rows only."""
    rows = labelled_sample(docs, labels, "quality", allowed, SAMPLE_ROWS, SAMPLE_BYTES).collect()  # bounded
    model = fit([(r["text"].encode(), r["y"]) for r in sorted(rows, key=lambda r: (r["_order"], r["doc_id"]))])

    def score(batches):
        import pyarrow as pa

        sizes = None if isinstance(model, float) else Sizes(*model[:2])
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                p = np.full(len(texts), model) if sizes is None else model[2]([sizes.inputs(t) for t in texts])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(score, "doc_id bigint, score double")
