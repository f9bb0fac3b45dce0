"""Parsing of raw message lines. Lines are built from the tables, written as text and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import timekeys
from telemetra.plans.inputs import (
    GPS_LINE_POINTS_SQL,
    GPS_LINES_SQL,
    LOG_SQL,
    gps_raw_lines,
    log_raw_lines,
)
from telemetra.plans.registry import query
from telemetra.plans.staging import staged
from telemetra.sources import lines as src


def gps_line_files(spark, sf_dir) -> str:
    return staged(spark, sf_dir, "gps-lines", lambda path: gps_raw_lines(spark, sf_dir).write.text(path))


def log_line_files(spark, sf_dir) -> str:
    return staged(spark, sf_dir, "log-lines", lambda path: log_raw_lines(spark, sf_dir).write.text(path))


def clean_gps_lines(spark, sf_dir):
    return src.clean_lines(spark.read.text(gps_line_files(spark, sf_dir)))


@query("line_strip_quotes", f"WITH {GPS_LINES_SQL} SELECT value FROM clean_lines")
def line_strip_quotes(spark, sf_dir):
    return clean_gps_lines(spark, sf_dir)


@query("gps_filter_cmd", f"WITH {GPS_LINES_SQL} SELECT value FROM clean_lines WHERE event_type <> 'signup'")
def gps_filter_cmd(spark, sf_dir):
    return src.filter_gps_lines(clean_gps_lines(spark, sf_dir))


_POINT_SQL = f"""WITH {GPS_LINE_POINTS_SQL}
SELECT terminal_id, time_id, speed, satellite_num, online_status FROM timed_points WHERE event_type <> 'signup'"""


def _keyed(points):
    return points.select(
        "terminal_id", timekeys.time_id(F.col("ts")).alias("time_id"), "speed", "satellite_num", "online_status"
    )


@query("gps_parse_messages", _POINT_SQL)
def gps_parse_messages(spark, sf_dir):
    return _keyed(src.parse_gps_lines(clean_gps_lines(spark, sf_dir)))


@query("gps_parse_single_point", f"{_POINT_SQL} AND i = 0")
def gps_parse_single_point(spark, sf_dir):
    return _keyed(src.parse_gps_first_points(clean_gps_lines(spark, sf_dir)))


@query(
    "gps_time_dual_format",
    f"""WITH {GPS_LINE_POINTS_SQL}
SELECT raw_time, time_id,
       CASE WHEN as_date THEN epoch_us(date_trunc('second', pts)) // 1000 ELSE epoch_us(pts) // 1000 END AS ms
FROM timed_points WHERE event_type <> 'signup'""",
)
def gps_time_dual_format(spark, sf_dir):
    points = src.parse_gps_lines(clean_gps_lines(spark, sf_dir))
    return points.select(
        "raw_time", timekeys.time_id(F.col("ts")).alias("time_id"), F.unix_millis("ts").alias("ms")
    )


@query("log_parse_lines", f"WITH {LOG_SQL} SELECT serial_num, terminal_id, ms, online_status FROM records")
def log_parse_lines(spark, sf_dir):
    records = src.parse_log_lines(src.clean_lines(spark.read.text(log_line_files(spark, sf_dir))))
    return records.select("serial_num", "terminal_id", F.unix_millis("ts").alias("ms"), "online_status")
