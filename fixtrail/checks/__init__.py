"""Registered queries on the driver tables and their SQL oracles."""

from __future__ import annotations

import importlib

MODULES = (
    "analytics_queries", "linking_queries", "integrity_queries", "shaping_queries", "change_queries", "diff_queries",
    "storage_queries", "report_queries",
)


def load() -> tuple[dict, dict]:
    """(queries, oracles) by name."""
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    from .registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
