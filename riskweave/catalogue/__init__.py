"""Registered queries over the given tables, with the SQL each is checked against."""

from __future__ import annotations

from riskweave.catalogue import credit, documents, learning, scoring, tables

_PARTS = (tables, credit, scoring, learning, documents)


def all_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
