"""Registered queries of the library and their DuckDB counterparts."""

from __future__ import annotations

from isoclime.plans import queries_base, queries_climate

MODULES = [queries_base, queries_climate]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.ORACLES.items()}
