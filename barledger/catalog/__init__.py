"""Registered queries over the given tables, each with its oracle SQL where one exists."""

from __future__ import annotations

import importlib

from barledger.catalog.registry import ENTRIES, Entry

_MODULES = [
    "normalizing",
    "features",
    "auditing",
    "campaigns",
    "forensic",
    "qualifying",
    "quality",
    "relational",
    "storing",
    "committing",
]


def entries() -> dict[str, Entry]:
    for module in _MODULES:
        importlib.import_module(f"barledger.catalog.{module}")
    return ENTRIES
