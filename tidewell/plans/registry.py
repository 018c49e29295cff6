"""All catalogue queries and their DuckDB oracles."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a query under its function's name, with the SQL that must give the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


for _module in ("inventory", "copies", "lifecycle", "exports", "arrays", "volumes", "streams", "decisions", "beads"):
    importlib.import_module(f"tidewell.plans.{_module}")
