"""Queries of the training-data operators, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    from glean.llm import (  # noqa: F401
        byte_language,
        embedding_dedup,
        jaccard_join,
        license_markup,
        mil_quality,
        mixing,
        packing,
        periodic_runs,
        quality_rules,
        secret_linking,
        suffix_dedup,
        term_divergence,
        url_trust,
    )
