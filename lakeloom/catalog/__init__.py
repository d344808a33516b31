"""Registered queries, one module per operator family."""

from __future__ import annotations

import importlib
import pkgutil

from lakeloom.registry import ENTRIES, Entry


def entries() -> dict[str, Entry]:
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
    return dict(ENTRIES)
