"""Live metrics: the batch rules over event-time windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemetra.functions import timekeys
from telemetra.operators import point_metrics as pm

WINDOW = "10 minutes"


def _time_id():
    return timekeys.time_id(F.col("window.start")).alias("time_id")


def gps_metrics(points: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The nine metrics per terminal and bucket, kept as state until the watermark passes the
    bucket; run in update mode, each batch gives the buckets that changed."""
    counted = (
        points.withWatermark("ts", delay)
        .groupBy("terminal_id", F.window("ts", WINDOW))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(rule).alias(name) for name, rule in pm.point_rules().items()],
        )
    )
    names = ["n", *pm.point_rules()]
    return pm.derive_metrics(counted.select("terminal_id", _time_id(), *names))


def log_counts(records: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Connects and closes per terminal and bucket."""
    return (
        records.withWatermark("ts", delay)
        .groupBy("terminal_id", F.window("ts", WINDOW))
        .agg(
            F.count_if(F.col("online_status") == 1).alias("connect_num"),
            F.count_if(F.col("online_status") == 0).alias("close_num"),
        )
        .select("terminal_id", _time_id(), "connect_num", "close_num")
    )


def zone_arrivals(routes: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Arrivals per zone and half hour, as windows close. Copies of a scan that come while its time is live count once."""
    scan = ["waybill_no", "bar_record_id", "zone_code", "ordinal", "bar_scan_tm"]
    return (
        routes.where(F.col("bar_scan_tm").isNotNull())
        .withWatermark("bar_scan_tm", delay)
        .dropDuplicatesWithinWatermark(scan)
        .groupBy("zone_code", F.window("bar_scan_tm", "30 minutes"))
        .agg(F.count(F.lit(1)).alias("arrivals"))
        .select("zone_code", F.date_format("window.start", "yyyyMMddHHmm").alias("half_hour"), "arrivals")
    )


def tumbling_counts(points: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Points per terminal and tumbling ten-minute window."""
    return (
        points.withWatermark("ts", delay)
        .groupBy("terminal_id", F.window("ts", WINDOW))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("terminal_id", _time_id(), "n")
    )
