"""Operators for preparing training data at corpus scale. Each module has its operator, its query and, where it can be said
in SQL, the query's SQL; nothing else in the library imports this folder."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "line_dedup",
    "suffix_dedup",
    "warc",
    "quality_rules",
    "packing",
    "byte_bpe",
    "suffix_tree_lm",
    "multi_index",
    "neighbour_quality",
    "jaccard_join",
    "merkle_manifest",
    "whitening",
    "debruijn_dedup",
)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in import_module(f"{__name__}.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in import_module(f"{__name__}.{m}").ORACLES.items()}
