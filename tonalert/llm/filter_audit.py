"""Operator 11, filter interaction audit by forward-backward path counting.

The filters are applied in every order. A state of the subset lattice is a set of filters that have been
applied; an order is a path from the empty set to the full one, and its step an edge that adds one
filter. What an edge removes does not depend on the path that led to its start:
the documents that pass the start's filters less those that pass the end's as well. So

1. one pass over the texts tells each document's failing filters as a bit mask, one aggregation
   counts documents per part and mask (two to the number of filters rows a part);
2. per part, the counts of documents that survive each state: all, good and toxic ones;
3. forward counts (orders that reach a state) and backward counts (orders that leave it) give the number of
   orders through each edge; a filter's Shapley sum weights the removals of its edges by them;
4. the step of an order is an edge of the same lattice, so per-order rows are read off the same
   survivor counts.

Filter E needs other rows: copies of a text are found by the SHA-256 of the text and their smallest
doc_id. Texts that more than one in HOT_SHARE rows hold are at most HOT_SHARE, so their list is
broadcast; the others are joined by hash, where no key has many rows.

Edge cases: a NULL text is empty (it has no words, so it fails A, not B, C or D); a NULL part is ''. A NULL doc_id has no smaller one, never fails E and has no labels, nor do rows that repeat a doc_id fail E by each
other. A document is good or toxic if any of its label rows says 1. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalert.llm.common import stored, text_or_empty
from tonalert.operators.joins import checked_broadcast

FILTERS = "ABCDE"
HOT_SHARE = 1000
MIN_WORDS = 200


def paths(n: int) -> dict:
    """Edge (state, filter) -> number of orders through it, by counting paths forward from the empty
    set and backward from the full one. States are bit masks of ``n`` filters."""
    full = (1 << n) - 1
    reach, leave = {0: 1}, {full: 1}
    for state in range(1, full + 1):
        reach[state] = sum(reach[state & ~(1 << f)] for f in range(n) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        leave[state] = sum(leave[state | 1 << f] for f in range(n) if not state >> f & 1)
    return {(s, f): reach[s] * leave[s | 1 << f] for s in range(full + 1) for f in range(n) if not s >> f & 1}


def words(text: Column) -> Column:
    """Words between ASCII white space. One blank as separator keeps the split off regular expressions."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), "")


def text_masks(docs: DataFrame, part: str = "source") -> DataFrame:
    """(doc_id, part, digest, mask) per row; ``mask`` has a bit per failing filter of A to D."""
    t = text_or_empty()
    row = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), t.alias("t"))
    counted = F.explode(F.array(F.struct(F.col("t"), words(F.col("t")).alias("w")))).alias("r")  # the words are split once per row
    row = row.select("doc_id", "part", counted).select("doc_id", "part", "r.t", "r.w")
    n, length = F.size("w"), F.char_length("t")
    capitals = length - F.char_length(F.translate("t", string.ascii_uppercase, ""))
    failed = [n < MIN_WORDS, 100 * F.size(F.array_distinct("w")) < 50 * n, 100 * capitals.cast("bigint") > 2 * length, F.col("t").rlike("[#$%&*|]")]
    mask = F.lit(0)
    for bit, condition in enumerate(failed):
        mask = mask + F.when(condition, F.lit(1 << bit)).otherwise(F.lit(0))
    return row.select("doc_id", "part", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"), mask.alias("mask"))


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, digest, mask, ...) with the bit of filter E set where a smaller doc_id has the same text."""
    bit = 1 << FILTERS.index("E")
    groups = stored(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                    .where("first < last"), "audit-copies")
    total = rows.count()
    hot = groups.where(F.col("n") * HOT_SHARE > total)  # fewer than HOT_SHARE rows
    rare = groups.where(F.col("n") * HOT_SHARE <= total)
    out = rows.join(F.broadcast(hot.select("digest", F.col("first").alias("hot_first"))), "digest", "left")
    # Rows of hot texts get keys of their own, which match nothing, so that they spread in a shuffle join.
    spread = F.concat(F.lit("row "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")
    out = out.withColumn("key", F.when(F.col("hot_first").isNull(), F.col("digest")).otherwise(spread))
    out = out.join(checked_broadcast(rare.select(F.col("digest").alias("key"), "first"), materialize=False), "key", "left")
    failed = F.coalesce(F.col("doc_id") > F.coalesce("hot_first", "first"), F.lit(False))
    return out.withColumn("mask", F.col("mask") + F.when(failed, F.lit(bit)).otherwise(F.lit(0))).drop("key", "hot_first", "first")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` (0 or 1)."""
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return rows.join(checked_broadcast(marks), "doc_id", "left").fillna(0, ["good", "toxic"])


MEASURES = ["n", "good", "toxic"]


def survivors(rows: DataFrame, n: int = len(FILTERS)) -> DataFrame:
    """Per part, arrays by state of the documents that pass all its filters (``n``, ``good``, ``toxic``), and
    the array ``only`` by filter of those that fail it alone. ``rows``: part, mask, good, toxic."""
    per = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").cast("bigint").alias("good"), F.sum("toxic").cast("bigint").alias("toxic"))
    sums = [F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(s) == 0, F.col(m))), F.lit(0)).alias(f"{m}_{s}") for m in MEASURES for s in range(1 << n)]
    only = [F.coalesce(F.sum(F.when(F.col("mask") == 1 << f, F.col("n"))), F.lit(0)).alias(f"only_{f}") for f in range(n)]
    out = per.groupBy("part").agg(*sums, *only)
    return out.select("part", *[F.array(*[F.col(f"{m}_{s}") for s in range(1 << n)]).alias(m) for m in MEASURES],
                      F.array(*[F.col(f"only_{f}") for f in range(n)]).alias("only"))


def shapley_sums(n: int = len(FILTERS)) -> Column:
    """By filter, its removals summed over all orders: the lattice's edges weighted by the orders through them."""
    through = paths(n)

    def removals(f):
        out = F.lit(0).cast("bigint")
        for (s, g), orders in through.items():
            if g == f:
                out = out + orders * (F.get("n", F.lit(s)) - F.get("n", F.lit(s | 1 << f)))
        return out

    return F.array(*[removals(f) for f in range(n)])


def order_steps(states: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, read from the lattice's survivor counts."""
    steps = []
    for order in itertools.permutations(range(len(filters))):
        state = 0
        for k, f in enumerate(order):
            steps.append((int("".join(str(x) for x in order)), k + 1, f, 1 << f, state, state | 1 << f))
            state |= 1 << f
    names = ["order", "step", "f", "own", "before", "after"]
    listed = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, row)]) for row in steps])
    rows = states.withColumn("shapley", shapley_sums(len(filters))).withColumn("e", F.explode(listed))

    def lost(measure):
        return F.get(measure, F.col("e.before")) - F.get(measure, F.col("e.after"))

    letters = F.translate(F.lpad(F.col("e.order").cast("string"), len(filters), "0"), "0123456789"[:len(filters)], filters)
    failing = F.get("n", F.lit(0)) - F.get("n", F.col("e.own"))
    return rows.select(
        "part", letters.alias("filter_order"), F.col("e.step").alias("step"), F.get("n", F.col("e.after")).alias("kept"), lost("n").alias("removed"),
        (failing - lost("n")).alias("redundant"), F.get("only", F.col("e.f")).alias("unique_fails"), lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"), F.get("shapley", F.col("e.f")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of filters A to E over ``docs`` (doc_id, text, ``part``) with ``labels`` (doc_id, quality, toxic)."""
    rows = with_copies(stored(text_masks(docs, part), "audit-masks"))
    return order_steps(survivors(with_labels(rows, labels)))
