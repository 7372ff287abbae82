"""Registered queries: one for each group of operators, over stand-in tables, with the SQL that says the same."""

from __future__ import annotations

from rasterloom.plans import catalogue, rasters, splits, texts

FLAGSHIP = "split_assignment"
_PARTS = (splits, catalogue, texts, rasters)


def queries() -> dict:
    return {name: run for part in _PARTS for name, (run, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
