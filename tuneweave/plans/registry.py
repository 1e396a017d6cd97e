"""All registered queries and their SQL."""

from __future__ import annotations

import importlib

MODULES = ["corpus_queries", "packing_queries", "evaluation_queries", "log_queries", "run_queries"]


def _collect(name: str) -> dict:
    found: dict = {}
    for module in MODULES:
        found.update(getattr(importlib.import_module(f"{__package__}.{module}"), name))
    return found


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE")
