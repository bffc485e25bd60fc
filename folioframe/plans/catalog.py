"""All registered queries of the engine's own operators, with their SQL twins."""

from __future__ import annotations

import importlib

from folioframe.plans import base

MODULES = ("strings", "scalars", "duplicates", "stages", "sequence", "compare", "listing", "rules", "documents", "continuity", "surface")


def _load():
    for m in MODULES:
        importlib.import_module(f"folioframe.plans.{m}")


def queries():
    _load()
    return dict(base.QUERIES)


def oracle_sql():
    _load()
    return dict(base.SQL)
