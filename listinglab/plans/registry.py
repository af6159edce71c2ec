"""Registry of checkable queries: Spark plan + (optional) DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every query module (they register on import)."""
    from . import q_listing, q_model, q_reviews, q_stored  # noqa: F401
