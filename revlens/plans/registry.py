"""Named queries: name → (Spark builder, DuckDB oracle builder or None)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    from . import (q_eval, q_features, q_labels, q_models, q_reviews,  # noqa: F401
                   q_reports, q_stats, q_streams)
