"""Registry of named queries over the test tables.

Each entry pairs a Spark query ``fn(spark, sf_dir) -> DataFrame`` with the
DuckDB text of the same result when one can be written (``sql``), and the
SURVEY §2 operator ids it exercises. ``__spark_entry__`` exposes the registry.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]


_QUERIES: dict[str, Query] = {}

MODULES = ("catalog_lines", "catalog_explore", "catalog_aggregates", "catalog_series", "catalog_sinks",
           "catalog_distributions", "catalog_forecast", "catalog_segments")


def register(name: str, ops: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = Query(name, fn, sql, tuple(o.strip() for o in ops.split(",")))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
    return dict(_QUERIES)
