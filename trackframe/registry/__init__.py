"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable


def _registries():
    from trackframe.registry import measures, rows, sequences, service

    return [m.registry for m in (rows, sequences, measures, service)]


def all_queries() -> dict[str, Callable]:
    return {name: q for r in _registries() for name, q in r.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: s for r in _registries() for name, s in r.sql.items()}
