"""Registry of named queries: a Spark builder and, where SQL can express it, DuckDB text.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame whose integer columns are BIGINT
and whose real columns are DOUBLE (rounded where the SQL side rounds), so both engines give the
same types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def normalise(df: DataFrame) -> DataFrame:
    """Integers -> BIGINT, floats -> DOUBLE, so result types line up across engines."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "
