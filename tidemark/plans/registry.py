"""Registry of driver queries: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def load_all() -> None:
    # importing the modules registers their queries
    from tidemark.plans import catalog_batch, catalog_files, catalog_tables  # noqa: F401
