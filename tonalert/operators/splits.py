"""Splitting, sampling and ordering (L1-L9, U1, U2) by a reproducible hash order.

The original draws random permutations; Spark cannot replay those (different generators), so
rows are ordered by ``md5(key || ':' || seed)`` instead, with the same split sizes.

Exact sizes need a global rank, but a window over the whole table would put every row in one
task. Instead:

1. every row gets a bucket = the first 16 bits of its hash (uniform, at most 65,536 buckets, and
   one for NULL keys, which come first);
2. rows are counted per bucket (partial aggregation, a result of at most 65,537 rows);
3. only the buckets that hold a cut point are ranked row by row (about N / 65,536 rows each), which
   gives the exact hash and key at the cut;
4. all rows are labelled by comparing their (hash, key) with the cuts: one narrow pass, no join.

Rows that share a key (NULL included) stay together, so a cut that falls among them moves to their
end. Building such a DataFrame runs the counting jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonalert.operators.joins import checked_broadcast

BUCKET_HEX = 4  # 16 bits -> 65,536 buckets


def hash_order(key, seed: int) -> "F.Column":
    """The order key of a row; NULL keys get the empty string."""
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.md5(F.concat(k.cast("string"), F.lit(f":{seed}"))), F.lit(""))


def _bucketed(df: DataFrame, key: str, seed: int) -> DataFrame:
    number = F.conv(F.substring("_h", 1, BUCKET_HEX), 16, 10).cast("int")
    return df.withColumn("_h", hash_order(key, seed)).withColumn("_b", F.when(F.col("_h") == "", F.lit(-1)).otherwise(number))


def _bucket_counts(b: DataFrame) -> list[tuple[int, int]]:
    """(bucket, rows) in order: at most 65,537 of them, whatever the size of the table."""
    return sorted((r["_b"], r["n"]) for r in b.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect())


def _cut_rows(b: DataFrame, key: str, cuts: list[int], counts: list[tuple[int, int]]) -> list:
    """For each cut (a 1-based rank) the (hash, key) of its row, None for a cut before all rows."""
    want: dict[int, set] = {}
    place = {}
    for c in cuts:
        before = 0
        for bucket, n in counts:
            if before < c <= before + n:
                want.setdefault(bucket, set()).add(c - before)
                place[c] = (bucket, c - before)
                break
            before += n
    if not want:
        return [None for _ in cuts]
    inside = b.filter(F.col("_b").isin(list(want))).select("_b", "_h", F.col(key).alias("_k"))
    ranked = inside.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h", "_k")))
    at = F.lit(False)
    for bucket, ranks in want.items():
        at = at | ((F.col("_b") == bucket) & F.col("_r").isin(list(ranks)))
    found = {(r["_b"], r["_r"]): (r["_h"], r["_k"]) for r in ranked.filter(at).collect()}  # one row per cut
    return [found[place[c]] if c in place else None for c in cuts]


def assign_ranges(df: DataFrame, key: str, seed: int, cuts_of_n, labels: list[str], col: str = "split") -> DataFrame:
    """Label rows by their exact rank r (1-based) in hash order: ``labels[i]`` when
    ``cuts[i-1] < r <= cuts[i]``; ``cuts_of_n(N)`` gives the len(labels)-1 cut points."""
    narrow = _bucketed(df.select(key), key, seed)
    counts = _bucket_counts(narrow)
    n = sum(c for _, c in counts)
    cuts = [int(c) for c in cuts_of_n(n)]
    rows = _cut_rows(narrow, key, cuts, counts)
    h, kind = hash_order(key, seed), df.schema[key].dataType
    label = F.lit(labels[-1])
    for c, row, name in reversed(list(zip(cuts, rows, labels))):
        if row is None:  # nothing before the cut, or everything
            within = F.lit(c >= n and n > 0)
        elif row[1] is None:
            within = h <= F.lit(row[0])
        else:
            within = (h < F.lit(row[0])) | ((h == F.lit(row[0])) & (F.col(key) <= F.lit(row[1]).cast(kind)))
        label = F.when(within, F.lit(name)).otherwise(label)
    return df.withColumn(col, label)


def py_round(x: float) -> int:
    return int(round(x))


def split_exact(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42, col: str = "split") -> DataFrame:
    """L1: ``train`` for the first round(frac * N) rows in hash order, ``test`` for the rest."""
    return assign_ranges(df, key, seed, lambda n: [py_round(frac * n)], ["train", "test"], col)


def split_hashed(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42, col: str = "split") -> DataFrame:
    """L1, approximate size: one pass, no aggregation (for when the size need not be exact)."""
    u = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    return df.withColumn(col, F.when(u < frac, F.lit("train")).otherwise(F.lit("test")))


def split_groups(df: DataFrame, group: str, fracs=(0.8, 0.1, 0.1), seed: int = 42,
                 labels=("train", "val", "test"), col: str = "split") -> DataFrame:
    """L2: split distinct groups (e.g. images) with truncated sizes (remainder to the last label);
    every row follows its group."""
    groups = df.select(group).distinct()

    def cuts(n):
        out, acc = [], 0
        for f in fracs[:-1]:
            acc += int(f * n)
            out.append(acc)
        return out

    assigned = assign_ranges(groups, group, seed, cuts, list(labels), col)
    side = checked_broadcast(assigned.withColumnRenamed(group, "_group"))
    return df.join(side, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def split_nested(df: DataFrame, key: str, subset: float = 0.1, frac: float = 0.8, seed: int = 42,
                 col: str = "split") -> DataFrame:
    """L3: a subset of int(subset * N) rows, then train = int(frac * S) of it, val the rest."""
    sub = assign_ranges(df, key, seed, lambda n: [int(subset * n)], ["in", "out"], "_part")
    sub = sub.filter(F.col("_part") == "in").drop("_part")
    return assign_ranges(sub, key, seed + 1, lambda n: [int(frac * n)], ["train", "val"], col)


def sample_fraction(df: DataFrame, key: str, frac: float = 0.1, seed: int = 42, exact: bool = True) -> DataFrame:
    """L4: round(frac * N) rows in hash order (exact), or Spark's Bernoulli sample (size varies)."""
    if not exact:
        return df.sample(withReplacement=False, fraction=frac, seed=seed)
    s = assign_ranges(df, key, seed, lambda n: [py_round(frac * n)], ["in", "out"], "_part")
    return s.filter(F.col("_part") == "in").drop("_part")


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first ``n`` rows by ``order`` (top-k per partition, then merged)."""
    return df.orderBy(order).limit(n)


def shuffle(df: DataFrame, key: str, seed: int = 42, col: str = "pos") -> DataFrame:
    """Rows in hash order with their exact position (0-based).

    Every row is ranked within its bucket (a shuffle by bucket, which a reshuffle needs anyway),
    plus the count of rows in earlier buckets (a table of at most 65,537 rows, broadcast).
    """
    b = _bucketed(df, key, seed)
    before, rows = 0, []
    for bucket, n in _bucket_counts(_bucketed(df.select(key), key, seed)):
        rows.append((bucket, before))
        before += n
    table = F.broadcast(df.sparkSession.createDataFrame(rows, "_b int, _before bigint"))
    w = Window.partitionBy("_b").orderBy("_h", key)
    out = b.join(table, "_b").withColumn(col, F.col("_before") + F.row_number().over(w) - 1)
    return out.drop("_h", "_b", "_before")


def batches(df: DataFrame, key: str, size: int, seed: int = 42, col: str = "batch", slot: str = "slot") -> DataFrame:
    """Fixed-size batches in hash order (shuffled, then cut every ``size`` rows; the last batch
    may be short): ``batch = pos div size`` and ``slot = pos mod size`` from L6's exact position,
    so no single-partition sort is needed and a batch never depends on how rows are partitioned."""
    pos = F.col("_pos")
    return shuffle(df, key, seed, col="_pos").withColumns({
        col: F.floor(pos / F.lit(size)).cast("bigint"),
        slot: F.pmod(pos, F.lit(size)).cast("bigint"),
    }).drop("_pos")


def by_key(df: DataFrame, order: str) -> DataFrame:
    """Sort by a column (a distributed range sort)."""
    return df.orderBy(order)


def union_splits(parts: dict[str, DataFrame], col: str = "split") -> DataFrame:
    """The same frames per split, unioned by name with a split column, for one pass."""
    out = None
    for name, part in parts.items():
        p = part.withColumn(col, F.lit(name))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out
