"""Queries and SQL twins of this package, by registered name."""

from __future__ import annotations

from . import oracle, queries


def llm_queries() -> dict:
    return {name: getattr(queries, name) for name in dir(queries) if name.startswith("op")}


def llm_oracle_sql() -> dict:
    return oracle.oracle_sql()
