"""Labelled rows, bounded samples of them, and a small logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalert.operators.joins import checked_broadcast

PIECES = 16  # parts of a long text that a sample holds


def spread_pieces(text: Column, max_bytes: int) -> Column:
    """``text`` if it has at most ``max_bytes``, else PIECES whole-word pieces spread evenly over it, of as many bytes in all at most."""
    piece = max_bytes // (4 * PIECES) - 1  # a code point has at most four bytes
    step = (F.char_length(text) - piece) / (PIECES - 1)
    cut = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.regexp_replace(F.substring(text, F.floor(i * step).cast("int") + 1, F.lit(piece)), r"^\S*\s|\s\S*$", ""))
    return F.when(F.octet_length(text) <= max_bytes, text).otherwise(F.array_join(cut, "\n"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int, max_bytes: int) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled documents per class: of the ``allowed`` (a condition on doc_id) that
    have a text, those whose hashed ids are smallest. Of a text of more than ``max_bytes`` pieces from all over it are
    taken (``spread_pieces``). Rows without an id, a text or a 0/1 label are left out before any are chosen; a doc_id counts once."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & allowed)
    known = known.groupBy("doc_id").agg(F.max(label).alias("y")).withColumn("_order", F.xxhash64(F.lit(7), "doc_id"))
    usable = docs.where("octet_length(text) > 0").select("doc_id").join(known, "doc_id").dropDuplicates(["doc_id"])
    parts = [usable.where(F.col("y") == y).orderBy("_order", "doc_id").limit(rows) for y in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))  # at most 2 * rows ids
    sample = docs.where("octet_length(text) > 0").select("doc_id", "text").join(chosen, "doc_id")
    return sample.dropDuplicates(["doc_id"]).select("doc_id", spread_pieces(F.col("text"), max_bytes).alias("text"), "y", "_order")


def labelled_ids(docs: DataFrame, labels: DataFrame, label: str, allowed: Column) -> DataFrame:
    """(doc_id, row_hash, y, _order, copies) of every labelled document that is ``allowed`` and has a text. Of rows with the same id
    those of one text count, ``copies`` of them."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & allowed)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).withColumn("_order", F.xxhash64(F.lit(7), "doc_id"))
    usable = docs.where("octet_length(text) > 0").select("doc_id", F.xxhash64("text").alias("row_hash"))
    usable = usable.groupBy("doc_id").agg(F.min("row_hash").alias("row_hash"), F.count(F.lit(1)).alias("copies"))
    return usable.join(known, "doc_id")


def labelled_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, text, y, _order): the whole texts of the rows of ``chosen`` (``labelled_ids``, written), each doc_id once. The texts are
    shuffled only if ``chosen`` outgrows a broadcast, or for ids that are there twice."""
    texts = docs.where("octet_length(text) > 0").select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
    rows = texts.join(checked_broadcast(chosen, materialize=False), ["doc_id", "row_hash"])
    out = rows.where("copies = 1")
    if not chosen.where("copies > 1").isEmpty():
        out = out.unionByName(rows.where("copies > 1").dropDuplicates(["doc_id"]))
    return out.select("doc_id", "text", "y", "_order")


class Logistic:
    """Ridge logistic regression on a few standardised inputs, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-2):
        x, y = np.asarray(x, float), np.asarray(y, float)
        self.mean, spread = x.mean(axis=0), x.std(axis=0)
        self.spread = np.where(spread > 1e-9, spread, 1.0)
        a = np.c_[np.ones(len(x)), (x - self.mean) / self.spread]
        weight = np.ones(len(x)) if weight is None else weight
        self.w = np.zeros(a.shape[1])
        penalty = ridge * np.eye(a.shape[1])
        penalty[0, 0] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ self.w, -30, 30)))
            h = (a.T * (weight * (p * (1 - p) + 1e-6))) @ a + penalty
            step = np.linalg.solve(h, a.T @ (weight * (y - p)) - penalty @ self.w)
            self.w += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-8:
                break

    @classmethod
    def of_rows(cls, rows: DataFrame, inputs: list[str], y: str, ridge: float = 1e-2) -> Logistic:
        """The same fit over the rows of a table: each step is one aggregate of sums, no row leaves the tasks."""
        self, k = cls.__new__(cls), len(inputs) + 1
        stats = rows.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(inputs) for f in (F.avg, F.stddev_pop)]).first()
        self.mean, spread = np.array(stats[0::2], float), np.array(stats[1::2], float)
        self.spread = np.where(spread > 1e-9, spread, 1.0)
        a = [F.lit(1.0), *[(F.col(c) - F.lit(float(m))) / F.lit(float(d)) for c, m, d in zip(inputs, self.mean, self.spread)]]
        self.w, penalty = np.zeros(k), ridge * np.eye(k)
        penalty[0, 0] = 1e-6
        for _ in range(50):
            z = sum((x * F.lit(float(w)) for x, w in zip(a[1:], self.w[1:])), F.lit(float(self.w[0])))
            z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))
            p = rows.select(F.col(y).cast("double").alias("_y"), (1 / (1 + F.exp(-z))).alias("_p"), *[x.alias(f"_a{i}") for i, x in enumerate(a)])
            v = F.col("_p") * (1 - F.col("_p")) + 1e-6
            sums = p.agg(*[F.sum(F.col(f"_a{i}") * (F.col("_y") - F.col("_p"))).alias(f"g{i}") for i in range(k)],
                         *[F.sum(F.col(f"_a{i}") * F.col(f"_a{j}") * v).alias(f"h{i}{j}") for i in range(k) for j in range(k)]).first()
            h = np.array(sums[k:], float).reshape(k, k) + penalty
            step = np.linalg.solve(h, np.array(sums[:k], float) - penalty @ self.w)
            self.w += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-8:
                break
        return self

    def __call__(self, x) -> np.ndarray:
        z = ((np.asarray(x, float) - self.mean) / self.spread) @ self.w[1:] + self.w[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
