"""Registered queries with their SQL twins."""

from __future__ import annotations

import importlib

from plainloom.plans import catalog

MODULES = ("basics", "profiling", "text", "features", "modelling", "files", "closed", "structure")


def load():
    """Import every query module; return (queries, oracle SQL)."""
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return dict(catalog.QUERIES), dict(catalog.ORACLES)
