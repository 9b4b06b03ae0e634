"""Label recoding, probabilities and class rules as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonalert.constants import BINARY_AT, NEUTRAL_BAND, SENTIMENT_TO_IDX


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode_target(c) -> Column:
    """P5: 4 -> 2; every other value (0, and a 2 already there) unchanged."""
    c = _col(c)
    return F.when(c == 4, F.lit(2)).otherwise(c)


def loss_label(c) -> Column:
    """Label 2 reads as 1 for the loss only."""
    c = _col(c)
    return F.when(c == 2, F.lit(1.0)).otherwise(c.cast("double"))


def sentiment_to_idx(c) -> Column:
    """Positive 1, negative 0, neutral 2; anything else raises."""
    c = _col(c)
    out = None
    for name, idx in SENTIMENT_TO_IDX.items():
        out = F.when(c == name, F.lit(idx)) if out is None else out.when(c == name, F.lit(idx))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown sentiment: "), F.coalesce(c, F.lit("NULL")))))


def sentiment_is_one(c) -> Column:
    """1 if the value equals 1, else 0 (as written in the original, even for text labels)."""
    return F.when(_col(c) == 1, F.lit(1)).otherwise(F.lit(0))


def sigmoid(x) -> Column:
    """Logistic function of a logit."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def class_binary(p) -> Column:
    """P >= 0.5 -> 2, else 0."""
    return F.when(_col(p) >= BINARY_AT, F.lit(2)).otherwise(F.lit(0))


def class_banded(p) -> Column:
    """P < 0.45 -> 0, p > 0.55 -> 2, else 1 (both ends neutral)."""
    p = _col(p)
    lo, hi = NEUTRAL_BAND
    return F.when(p < lo, F.lit(0)).when(p > hi, F.lit(2)).otherwise(F.lit(1))


def class_round(p) -> Column:
    """Round half to even, so p = 0.5 -> 0."""
    return F.rint(_col(p)).try_cast("int")  # NaN -> NULL instead of a failed job


def cast_label(c, to: str = "int", safe: bool = True) -> Column:
    """Label cast; ``safe`` gives NULL for values that do not convert."""
    c = _col(c)
    return c.try_cast(to) if safe else c.cast(to)
