"""Registered queries: name -> (function, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ("transitions", "sequences", "statistics", "gates", "selection", "texts", "curating", "episodes", "releases")
_FOUND: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with the SQL that checks it."""

    def keep(f: Query) -> Query:
        _FOUND[f.__name__] = (f, sql)
        return f

    return keep


def _load() -> dict[str, tuple[Query, str | None]]:
    for m in MODULES:
        import_module(f"loomtrace.plans.{m}")
    return _FOUND


def queries() -> dict[str, Query]:
    return {k: f for k, (f, _) in _load().items()}


def oracles() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _load().items() if sql}
