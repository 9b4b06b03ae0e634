"""Metrics (G1-G11) as Spark aggregations.

Accuracy, agreement and loss are single-pass aggregates (partial aggregation, one tiny shuffle).
ROUGE-1 is computed in the row (a sort and a fold with scalar state); ROUGE-L (a longest common
subsequence, inherently sequential per pair) runs per row in Arrow batches with a bit-parallel
recurrence: O(n*m/64) word operations per pair. Neither shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.functions import labels as L
from tonalert.functions.porter import stem as porter_stem  # noqa: F401  (G9's default stemmer)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def accuracy(pred, label) -> Column:
    """G1: share of rows where prediction equals label; 0.0 for no rows (an aggregate)."""
    return F.coalesce(F.avg(F.when(_col(pred) == _col(label), F.lit(1.0)).otherwise(F.lit(0.0))), F.lit(0.0))


def accuracy3(p, label) -> Column:
    """Three-class accuracy of the banded class (P16) of probability ``p``."""
    return accuracy(L.class_banded(p), label)


def agreement(p, label) -> Column:
    """Percent of rows where round(p) (half to even) equals the label."""
    return accuracy(L.class_round(p), label) * 100.0


def bce_with_logits(x, y) -> Column:
    """Per-row binary cross-entropy on a logit, numerically stable."""
    x, y = _col(x), _col(y)
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def log_loss(x, y) -> Column:
    """Mean binary cross-entropy on logits (label 2 counts as 1, P6)."""
    return F.avg(bce_with_logits(x, L.loss_label(y)))


def max_chars(c) -> Column:
    """The longest text, in characters."""
    return F.max(F.char_length(_col(c)))


def n_rows() -> Column:
    """Row count."""
    return F.count(F.lit(1))


# ---------------------------------------------------------------- ROUGE -----------------------

def rouge_tokens(c) -> Column:
    """Tokens of the published ROUGE tokeniser: lower-case, anything outside a-z0-9 separates."""
    return F.array_remove(F.split(F.lower(_col(c)), "[^a-z0-9]+", -1), "")


def _f1(overlap, n_pred, n_ref) -> Column:
    p = overlap / n_pred
    r = overlap / n_ref
    return F.when((n_pred == 0) | (n_ref == 0) | (overlap == 0), F.lit(0.0)).otherwise(2 * p * r / (p + r))


def unigram_overlap(p, r) -> Column:
    """Size of the multiset intersection of two token arrays, in the row: the tokens of both
    sides are sorted together, then folded with a scalar state (current token, its count on each
    side, running overlap). O(n log n) per row, no shuffle, and the state never grows."""
    # sort_array sorts with the type's native ordering; array_sort without a comparator calls an
    # interpreted comparator lambda per comparison (about 8x slower here). No element is NULL.
    side = lambda t, sp, sr: F.struct(t.alias("tok"), F.lit(sp).alias("sp"), F.lit(sr).alias("sr"))
    merged = F.sort_array(F.concat(F.transform(_col(p), lambda t: side(t, 1, 0)),
                                   F.transform(_col(r), lambda t: side(t, 0, 1))))
    init = F.struct(F.lit(None).cast("string").alias("tok"), F.lit(0).alias("cp"), F.lit(0).alias("cr"),
                    F.lit(0).alias("ov"))

    def step(acc, x):
        same = acc["tok"].eqNullSafe(x["tok"])
        return F.when(same, F.struct(acc["tok"].alias("tok"), (acc["cp"] + x["sp"]).alias("cp"),
                                     (acc["cr"] + x["sr"]).alias("cr"), acc["ov"].alias("ov"))
                      ).otherwise(F.struct(x["tok"].alias("tok"), x["sp"].alias("cp"), x["sr"].alias("cr"),
                                           (acc["ov"] + F.least(acc["cp"], acc["cr"])).alias("ov")))

    return F.aggregate(merged, init, step, lambda acc: acc["ov"] + F.least(acc["cp"], acc["cr"]))


def _token_columns(df: DataFrame, keys: list[str], pred: str, ref: str, stem: Callable | None) -> DataFrame:
    """(keys, _p, _r): the tokens of both texts, stemmed if asked for."""
    toks = df.select(*keys, rouge_tokens(pred).alias("_p"), rouge_tokens(ref).alias("_r"))
    return toks if stem is None else stem_columns(toks, ["_p", "_r"], stem)


def rouge1(df: DataFrame, key: str, pred: str, ref: str, stem: Callable | None = None) -> DataFrame:
    """G7 per row: ``(key, rouge1)`` = F1 of the unigram multiset overlap (computed in the row)."""
    toks = _token_columns(df, [key], pred, ref, stem)
    # The overlap gets its own projection: the F1 formula reads it several times.
    ov = toks.select(key, unigram_overlap("_p", "_r").cast("double").alias("_ov"),
                     F.size("_p").alias("_np"), F.size("_r").alias("_nr"))
    return ov.select(key, _f1(F.col("_ov"), F.col("_np"), F.col("_nr")).alias("rouge1"))


def lcs_length(a, b) -> int:
    """Longest common subsequence length by the bit-parallel recurrence (Crochemore et al.,
    2001): one bit per token of ``b``, and for each token of ``a``
    ``V = (V + (V & M)) | (V & ~M)`` with ``M`` the positions of that token in ``b``; the LCS is
    the number of zero bits of ``V``. O(len(a) * len(b) / 64) machine-word operations."""
    if len(a) == 0 or len(b) == 0:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict = {}
    for j, t in enumerate(b):
        masks[t] = masks.get(t, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for t in a:
        m = masks.get(t)
        if m is None:
            continue
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


TOKENS_AT_ONCE = 500_000  # tokens of a batch that are held as Python values


def _row_slices(sizes):
    """(first row, row after the last) of slices with TOKENS_AT_ONCE tokens at most, or one row."""
    ends, a = sizes.cumsum(), 0
    while a < len(sizes):
        b = max(a + 1, int(ends.searchsorted((ends[a - 1] if a else 0) + TOKENS_AT_ONCE, side="right")))
        yield a, b
        a = b


def _common(a: list, b: list) -> tuple[int, int]:
    """How many tokens two lists have in common at their beginnings, and at the ends of what is left."""
    n = min(len(a), len(b))
    start = 0
    while start < n and a[start] == b[start]:
        start += 1
    end = 0
    while end < n - start and a[-1 - end] == b[-1 - end]:
        end += 1
    return start, end


def _lcs_f1(preds, refs):
    """F1 of the longest common subsequence of each pair of token lists (Arrow lists): equal tokens get one number, and
    what both lists begin and end with is counted without the recurrence."""
    import pyarrow as pa

    preds, refs = (x.cast(pa.list_(pa.string())) for x in (preds, refs))
    sizes = [x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (preds, refs)]
    out = np.zeros(len(preds), dtype=np.float64)
    for first, last in _row_slices(sizes[0] + sizes[1]):
        flat = [x.slice(first, last - first).flatten() for x in (preds, refs)]
        code = pa.concat_arrays(flat).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        at, of_b = 0, len(flat[0])
        for k in range(first, last):
            n_a, n_b = int(sizes[0][k]), int(sizes[1][k])
            a, b = code[at:at + n_a].tolist(), code[of_b:of_b + n_b].tolist()
            at, of_b = at + n_a, of_b + n_b
            if not a or not b:
                continue
            start, end = _common(a, b)
            n = start + end + lcs_length(a[start:n_a - end], b[start:n_b - end])
            if n:
                p, r = n / n_a, n / n_b
                out[k] = 2 * p * r / (p + r)
    return pa.array(out)


_lcs_f1_udf = F.arrow_udf(_lcs_f1, T.DoubleType())


def rougeL(df: DataFrame, key: str, pred: str, ref: str, stem: Callable | None = None) -> DataFrame:
    """G8 per row: ``(key, rougeL)`` = F1 of the longest common subsequence of tokens."""
    return _token_columns(df, [key], pred, ref, stem).select(key, _lcs_f1_udf("_p", "_r").alias("rougeL"))


def rouge_scores(df: DataFrame, key, pred: str, ref: str, stem: Callable | None = None) -> DataFrame:
    """G7 + G8 per row, ``(key, rouge1, rougeL)``, from one token projection, so a stemmer
    runs once for both. ``key``: a column or several. ``stem=porter_stem`` is the published scorer's
    ``use_stemmer=True``."""
    keys = [key] if isinstance(key, str) else list(key)
    j = _token_columns(df, keys, pred, ref, stem).select(
        *keys, unigram_overlap("_p", "_r").cast("double").alias("_ov"), F.size("_p").alias("_np"),
        F.size("_r").alias("_nr"), _lcs_f1_udf("_p", "_r").alias("rougeL"))
    return j.select(*keys, _f1(F.col("_ov"), F.col("_np"), F.col("_nr")).alias("rouge1"), "rougeL")


def evaluate_alerts(df: DataFrame, pred: str = "prediction", ref: str = "reference", stem: Callable | None = None,
                    split: str | None = None) -> DataFrame:
    """M9: mean ROUGE-1 and ROUGE-L F1 over rows, x 100, two decimals: one row, or one per value of
    ``split`` (train, validation and test apart)."""
    keys = [split] if split else []
    return rouge_scores(df, keys, pred, ref, stem).groupBy(*keys).agg(
        F.round(F.avg("rouge1") * 100, 2).alias("rouge1"),
        F.round(F.avg("rougeL") * 100, 2).alias("rougeL"),
        F.count(F.lit(1)).alias("n"),
    )


# 2^32 times the probability that a Poisson(1) number is 0, at most 1, at most 2, ...
POISSON_STEPS = [1580030169, 3160060338, 3950075422, 4213413784, 4279248374, 4292415292, 4294609778, 4294923276, 4294962463]
_DRAWS = 4  # draws of 32 bits in an MD5


def poisson_weights(key: Column, replicates: int) -> Column:
    """``replicates`` Poisson(1) numbers of a row, array<int>, drawn from the MD5 of its key: the same on every run and engine."""
    def numbers(k):
        digest = F.md5(F.concat_ws(":", key, k.cast("string")).cast("binary"))
        draws = [F.conv(F.substring(digest, 8 * d + 1, 8), 16, 10).cast("bigint") for d in range(_DRAWS)]
        steps = F.array(*[F.lit(x) for x in POISSON_STEPS])
        return F.array(*[F.size(F.filter(steps, lambda x: x <= u)) for u in draws])

    blocks = F.sequence(F.lit(0), F.lit(-(-replicates // _DRAWS) - 1))
    return F.slice(F.flatten(F.transform(blocks, numbers)), 1, replicates)


def bootstrap_intervals(scores: DataFrame, key: str | list[str], values: list[str], split: str | None = None, replicates: int = 100,
                        level: float = 0.95) -> DataFrame:
    """Low, middle and high of the means of ``values`` by a Poisson bootstrap, per ``split``, and ``n``.

    Every row draws how often it is in each replicate from its ``key``, so replicates are sums that add up over tasks
    in any order: one pass, partial sums before the shuffle, one row per replicate and split after it. The low and high
    end are the replicates at (1 - level) / 2 and (1 + level) / 2 by rank, the middle is the mean of all rows. A replicate
    without rows is left out."""
    keys, by = ([key] if isinstance(key, str) else list(key)), ([split] if split else [])
    name = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    rows = scores.select(*by, *values, F.posexplode(F.concat(F.array(F.lit(1)), poisson_weights(name, replicates))).alias("_b", "_w"))  # number 0: the rows themselves
    sums = rows.where("_w > 0").groupBy(*by, "_b").agg(F.sum("_w").alias("_n"), *[(F.sum(F.col("_w") * F.col(v)) / F.sum("_w")).alias(v) for v in values])
    tail = (1 - level) / 2

    def at(v, share):
        means = F.sort_array(F.collect_list(F.when(F.col("_b") > 0, F.col(v))))  # at most ``replicates`` numbers
        return F.element_at(means, F.greatest(F.ceil(F.size(means) * F.lit(share) - 1e-9), F.lit(1)).cast("int"))

    own = lambda c: F.max(F.when(F.col("_b") == 0, F.col(c)))
    return sums.groupBy(*by).agg(own("_n").alias("n"), *[c for v in values for c in (
        at(v, tail).alias(f"{v}_low"), own(v).alias(f"{v}_mid"), at(v, 1 - tail).alias(f"{v}_high"))])


def alert_intervals(df: DataFrame, key: str | list[str], pred: str = "prediction", ref: str = "reference", stem: Callable | None = None,
                    split: str | None = None, replicates: int = 100) -> DataFrame:
    """M9 with intervals: ROUGE-1 and ROUGE-L (x 100, two decimals) as low, middle and high per ``split``."""
    keys = [key] if isinstance(key, str) else list(key)
    scores = rouge_scores(df, [*keys, *([split] if split else [])], pred, ref, stem)
    out = bootstrap_intervals(scores, keys, ["rouge1", "rougeL"], split, replicates)
    return out.select(*[c if c in ("n", split) else F.round(F.col(c) * 100 + 1e-9, 2).alias(c) for c in out.columns])


def stem_columns(df: DataFrame, cols: list[str], stem: Callable[[str], str]) -> DataFrame:
    """Apply a stemmer to token arrays (only tokens longer than 3 characters, as the ROUGE
    scorer does), in the row: no token leaves its row and nothing is shuffled. The arrays stay
    in Arrow; the distinct tokens of some rows at a time are stemmed once."""

    def stemmed(lists):
        import pyarrow as pa

        lists = lists.cast(pa.list_(pa.string()))
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        parts = [pa.array([], pa.string())]
        for a, b in _row_slices(sizes):
            coded = lists.slice(a, b - a).flatten().dictionary_encode()
            stems = pa.array([stem(t) if len(t) > 3 else t for t in coded.dictionary.to_pylist()], pa.string())
            parts.append(stems.take(coded.indices))
        offsets = pa.array(np.append(0, sizes.cumsum()), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.concat_arrays(parts), mask=lists.is_null() if lists.null_count else None)

    udf = F.arrow_udf(stemmed, T.ArrayType(T.StringType()))
    return df.withColumns({c: F.coalesce(udf(c), F.array().cast("array<string>")) for c in cols})


def log_metrics(df: DataFrame, step: str, x: str, y: str) -> DataFrame:
    """Per-step metric table: accuracy (P15 against the label) and mean loss."""
    return df.groupBy(step).agg(
        accuracy(L.class_binary(L.sigmoid(x)), y).alias("accuracy"),
        log_loss(x, y).alias("loss"),
        n_rows().alias("n"),
    )


def best_step(metrics: DataFrame, step: str = "step", loss: str = "loss") -> DataFrame:
    """The step with the lowest loss; the earliest step on ties."""
    return metrics.agg(F.min_by(step, F.struct(loss, step)).alias("best_step"), F.min(loss).alias("best_loss"))
