"""Imports every query module so that the registry is complete."""

from __future__ import annotations

import importlib

_MODULES = [
    "q_entities",
    "q_text",
    "q_labels",
    "q_arrays",
    "q_splits",
    "q_metrics",
    "q_models",
    "q_taggers",
    "q_streams",
    "q_io",
]


def _load():
    for m in _MODULES:
        importlib.import_module(f"tonalert.plans.{m}")


def queries():
    _load()
    from tonalert.plans.registry import QUERIES

    return dict(sorted(QUERIES.items()))


def oracle_sql():
    _load()
    from tonalert.plans.registry import ORACLES

    return dict(sorted(ORACLES.items()))
