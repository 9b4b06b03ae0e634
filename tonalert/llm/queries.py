"""All queries of this subpackage (importing the modules fills the registry)."""

from __future__ import annotations

from tonalert.llm import q_audit, q_models, q_native, q_search  # noqa: F401
from tonalert.llm.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
