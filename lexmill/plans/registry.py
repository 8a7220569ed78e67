"""Named queries over the given tables, with their DuckDB twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: Modules of this package that hold QUERIES and ORACLES dictionaries.
MODULES: tuple[str, ...] = ("retrieval", "corpus", "ingestion", "monitoring")


def _gather(name: str) -> dict:
    found: dict = {}
    for module in MODULES:
        for key, value in getattr(importlib.import_module(f"lexmill.plans.{module}"), name).items():
            if key in found:
                raise ValueError(f"query {key} is registered twice")
            found[key] = value
    return found


def queries() -> dict[str, Query]:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("ORACLES")
