"""Small helpers shared by the Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def bind(value, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a lambda variable.

    Catalyst does not share a sub-expression that is written several times inside one
    expression tree (and never inside lambdas), so a function that reads an argument more than
    once binds it first: ``transform(array(value), v -> fn(v))[0]``.
    """
    return F.element_at(F.transform(F.array(col(value)), fn), 1)
