"""Session construction and the one session setting the results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "telemetra",
    master: str | None = None,
    time_zone: str = "UTC",
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution and skew-join splitting on.

    ``settings`` overrides anything here, e.g. ``spark.sql.shuffle.partitions`` or
    ``spark.sql.autoBroadcastJoinThreshold`` (-1 asks for sort-merge joins).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_time_zone(spark: SparkSession, time_zone: str) -> None:
    """Time keys are wall-clock text, so the session zone decides which bucket a point is in."""
    if spark.conf.get("spark.sql.session.timeZone") != time_zone:
        spark.conf.set("spark.sql.session.timeZone", time_zone)
