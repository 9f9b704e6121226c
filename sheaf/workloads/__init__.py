"""Queries over the driver's tables, with the same results in plain SQL.

Tables are first written out as publisher documents, inside the plan, and then
harvested; the SQL computes what must come back.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_MODULES = ("publishers", "fields", "tables", "runs")


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL if it has one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def load_all() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")
