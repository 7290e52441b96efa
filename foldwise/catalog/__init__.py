"""Named queries over the given tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
MODULES = ("rowwise", "joins", "aggregates", "folding", "nested", "texts", "learning",
           "combining", "explaining", "jobs", "profiling", "brief", "artifacts", "streams")


def query(name: str, sql: str | None = None):
    """Register a function of :class:`foldwise.catalog.bind.Tables`."""
    from foldwise.catalog.bind import Tables

    def register(fn):
        if name in QUERIES:
            raise KeyError(name)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"foldwise.catalog.{module}")
