"""Plain table operators (P1-P4, P12, P20): thin, declarative, pushed down by Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column selection (pruned down to the scan)."""
    return df.select(*cols)


def with_derived(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Derived columns, all in one projection."""
    return df.withColumns(exprs)


def fill_text(c) -> Column:
    """Missing text -> empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(""))


def has_suffix(c, exts: list[str], ignore_case: bool = False) -> Column:
    """File-name suffix test (``exts`` like ``[".jpg", ".png"]``)."""
    c = F.col(c) if isinstance(c, str) else c
    name = F.lower(c) if ignore_case else c
    test = None
    for e in exts:
        t = name.endswith(e.lower() if ignore_case else e)
        test = t if test is None else (test | t)
    return test


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder, cast and check columns against a declared schema."""
    return df.to(schema)


def peek(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """P20: the first ``n`` rows by key (a top-k, not a full sort)."""
    return df.orderBy(key).limit(n)
