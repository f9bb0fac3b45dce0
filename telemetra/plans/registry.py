"""Collects the queries of the plan modules."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telemetra.session import use_time_zone

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}

PLAN_MODULES = [
    "gps_metrics",
    "raw_lines",
    "sessions",
    "rollups",
    "cell_store",
    "functions",
    "sql_jobs",
    "routes",
    "streams",
]


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``key``, with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        @functools.wraps(run)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_time_zone(spark, "UTC")
            return run(spark, sf_dir)

        _queries[key] = in_utc
        if sql is not None:
            _oracles[key] = sql
        return in_utc

    return register


def _load() -> None:
    for name in PLAN_MODULES:
        importlib.import_module(f"telemetra.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracles)
