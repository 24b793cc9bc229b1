"""Named queries over the star-schema tables, each with SQL that checks it."""

from __future__ import annotations

import importlib
import pkgutil

from . import base


def load():
    """Import every query module once; returns (queries, check SQL)."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        if module.endswith("_queries"):
            importlib.import_module(f"{__name__}.{module}")
    return base.QUERIES, base.ORACLE
