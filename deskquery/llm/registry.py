"""The operators' queries and the SQL that checks them."""

from __future__ import annotations

import importlib

#: Modules with QUERIES (name: function of a session and a folder) and ORACLE (name: SQL).
MODULES = tuple(f"op{n:02}" for n in range(1, 11))


def _merged(what: str) -> dict:
    found: dict = {}
    for m in MODULES:
        found |= getattr(importlib.import_module(f"{__package__}.queries_{m}"), what)
    return found


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE")
