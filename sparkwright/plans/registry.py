"""All registered queries and oracle SQL, collected from the plan modules."""

from __future__ import annotations

from . import flights, models, search, text, trees

_MODULES = [flights, models, text, search, trees]


def queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
