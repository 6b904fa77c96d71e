"""Registered queries, one module per family, each with QUERIES and SQL."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("text", "safety", "metrics", "prepare", "trials", "configs", "images", "models", "streams")


def all_queries() -> dict:
    return {k: v for f in FAMILIES for k, v in import_module(f"{__name__}.{f}").QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {k: v for f in FAMILIES for k, v in import_module(f"{__name__}.{f}").SQL.items()}
