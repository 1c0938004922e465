"""Queries over the driver's tables, each with its SQL counterpart."""
from __future__ import annotations

import importlib

MODULES = ["q_expressions", "q_tables", "q_runs"]


def load():
    """(queries, sql) by name."""
    for m in MODULES:
        importlib.import_module(f"workload.{m}")
    from workload.registry import QUERIES, SQL

    return QUERIES, SQL
