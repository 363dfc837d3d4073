"""Queries over the given tables and their SQL, collected from the modules of this package."""

from __future__ import annotations

from siftloom.plans import fields, items, jobs, more, names, selection, vectors

MODULES: list = [items, names, vectors, selection, more, fields, jobs]
ENTRY = items.captions


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
