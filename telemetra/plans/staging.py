"""Tables and line files derived from the test tables, written once per application."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from telemetra.workspace import new_dir

_paths: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path ``write`` has filled, reused by later queries on the same data."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        path = new_dir(spark, name)
        write(path)
        _paths[key] = path
    return _paths[key]
