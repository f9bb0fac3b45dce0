"""Streaming jobs run over the tables as they would arrive, with their results read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra import jobs
from telemetra.operators import cells
from telemetra.operators import routes as route_ops
from telemetra.plans.inputs import (
    GPS_LINES_SQL,
    GPS_LONG_SQL,
    LOG_SQL,
    POINTS_SQL,
    ROUTES_SQL,
    SESSIONS_SQL,
    WIDE_SQL,
    gps_raw_lines,
    log_raw_lines,
    points_of,
    records_of,
    route_records,
    routes_of,
    table,
)
from telemetra.plans.registry import query
from telemetra.plans.routes import EXPORT_SQL, KEY_SQL
from telemetra.plans.sessions import SELF_JOIN_SQL
from telemetra.plans.staging import staged
from telemetra.schemas import GPS_METRIC_COLUMNS
from telemetra.sources import lines as src
from telemetra.streaming import late, metrics, sessions, sinks
from telemetra.workspace import new_dir

KEYS = ["terminal_id", "time_id"]


def table_stream(spark, sf_dir, name):
    # A pattern, because a file stream takes a folder or a pattern but not the path of one file.
    return sinks.parquet_stream(spark, table(spark, sf_dir, name).schema, f"{sf_dir}/{name}[.]parquet")


def _collect_upserts(spark, stream, keys):
    work = new_dir(spark, "stream")
    sinks.run_available(sinks.upsert_to_files(stream, f"{work}/out", f"{work}/checkpoint"))
    return sinks.read_upserts(spark, f"{work}/out", keys)


def _collect_appends(spark, stream, file_format="parquet"):
    work = new_dir(spark, "stream")
    sinks.run_available(sinks.append_to_files(stream, f"{work}/out", f"{work}/checkpoint", file_format))
    return spark.read.format(file_format).load(f"{work}/out")


# ---- scans -------------------------------------------------------------------------------


@query(
    "src_stream_lines",
    f"""WITH {GPS_LINES_SQL}, {LOG_SQL}
SELECT value FROM clean_lines
UNION ALL
SELECT 'serialNum:' || serial_num || ',terminalId:' || terminal_id || ',time:' || CAST(ms AS VARCHAR)
       || ',online:' || CAST(online_status AS VARCHAR) || ',serverIp:10.0.0.' || terminal_id FROM records
UNION ALL
SELECT 'heartbeat,terminalId:' || CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'error'""",
)
def src_stream_lines(spark, sf_dir):
    """GPS and log lines of two topics in one stream, quotes removed."""

    def write(path):
        gps_raw_lines(spark, sf_dir).write.text(f"{path}/topic=gps")
        log_raw_lines(spark, sf_dir).write.text(f"{path}/topic=log")

    stream = src.text_file_stream(spark, staged(spark, sf_dir, "topic-lines", write))
    return _collect_appends(spark, src.clean_lines(stream), "text")


@query(
    "route_stream_scan",
    f"""WITH lines AS ({EXPORT_SQL})
SELECT md5(line) AS payload_md5, CAST(strlen(line) AS INTEGER) AS payload_bytes FROM lines""",
)
def route_stream_scan(spark, sf_dir):
    """Route messages as they come: binary values that are never decoded as text."""

    def write(path):
        messages = route_ops.export_lines(route_records(spark, sf_dir)).select(F.col("line").cast("binary").alias("value"))
        messages.write.parquet(path)

    path = staged(spark, sf_dir, "route-messages", write)
    stream = sinks.parquet_stream(spark, spark.read.parquet(path).schema, path)
    messages = _collect_appends(spark, stream.select("value"))
    return messages.select(F.md5("value").alias("payload_md5"), F.octet_length("value").alias("payload_bytes"))


# ---- metrics -----------------------------------------------------------------------------


@query("stream_gps_metrics", f"WITH {WIDE_SQL} SELECT * FROM wide")
def stream_gps_metrics(spark, sf_dir):
    return _collect_upserts(spark, metrics.gps_metrics(points_of(table_stream(spark, sf_dir, "events"))), KEYS)


@query(
    "stream_log_counts",
    f"""WITH {LOG_SQL}
SELECT terminal_id, time_id, count(*) FILTER (WHERE online_status = 1) AS connect_num,
       count(*) FILTER (WHERE online_status = 0) AS close_num
FROM records GROUP BY terminal_id, time_id""",
)
def stream_log_counts(spark, sf_dir):
    return _collect_upserts(spark, metrics.log_counts(records_of(table_stream(spark, sf_dir, "events"))), KEYS)


@query(
    "stream_tumbling_window",
    f"""WITH {POINTS_SQL}
SELECT terminal_id, time_id, count(*) AS n FROM points
WHERE time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE
      <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM points)
GROUP BY terminal_id, time_id""",
)
def stream_tumbling_window(spark, sf_dir):
    """Append mode: a window comes out once, after the watermark has passed its end."""
    return _collect_appends(spark, metrics.tumbling_counts(points_of(table_stream(spark, sf_dir, "events"))))


def _arrivals(spark, sf_dir, slices, start_query, inbox=None):
    """Let slices of the events arrive one after the other; the query restarts from its
    checkpoint for each, so every slice is at least one micro-batch of its own."""
    events = table(spark, sf_dir, "events")
    inbox = inbox or new_dir(spark, "inbox")
    for part in slices:
        events.where(part).write.mode("append").parquet(inbox)
        sinks.run_available(start_query(sinks.parquet_stream(spark, events.schema, inbox)))


@query(
    "stream_late_drop",
    f"""WITH {POINTS_SQL},
mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE AS w FROM points WHERE online_status = 1)
SELECT terminal_id, time_id, count(*) AS n FROM points, mark
WHERE online_status = 1 OR time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE > w
GROUP BY terminal_id, time_id""",
)
def stream_late_drop(spark, sf_dir):
    """Error events arrive after all others; those whose window is closed by then do not count."""
    work = new_dir(spark, "stream")
    is_late, second_half = F.col("event_type") == "error", F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")

    def start(events):
        counted = metrics.tumbling_counts(points_of(events))
        return sinks.upsert_to_files(counted, f"{work}/out", f"{work}/checkpoint")

    _arrivals(spark, sf_dir, [~is_late & ~second_half, ~is_late & second_half, is_late], start)
    return sinks.read_upserts(spark, f"{work}/out", KEYS)


@query("stream_late_corrected", f"WITH {GPS_LONG_SQL} SELECT * FROM gps_long")
def stream_late_corrected(spark, sf_dir):
    """The same arrivals into cells; a second query lists the buckets of late points, which are counted again."""
    work, inbox, path = new_dir(spark, "stream"), new_dir(spark, "inbox"), new_dir(spark, "cells")
    is_late, second_half = F.col("event_type") == "error", F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    events = table(spark, sf_dir, "events")
    for part in (~is_late & ~second_half, ~is_late & second_half, is_late):
        events.where(part).write.mode("append").parquet(inbox)
        points = points_of(sinks.parquet_stream(spark, events.schema, inbox))
        sinks.run_available(jobs.live_cells(metrics.gps_metrics(points), GPS_METRIC_COLUMNS, path, f"{work}/metrics"))
        sinks.run_available(late.gather_late(points, f"{work}/late", f"{work}/late-checkpoint"))
    jobs.correct_late_points(points_of(spark.read.parquet(inbox)), f"{work}/late", path)
    return jobs.metrics_of_cells(cells.stored_cells(spark, path)).drop("day")


# ---- sessions ----------------------------------------------------------------------------


@query("stream_session_pairs", SELF_JOIN_SQL)
def stream_session_pairs(spark, sf_dir):
    """Connects and closes of one stream, each session reduced to its two ends."""
    work = new_dir(spark, "sessions")
    records = records_of(table_stream(spark, sf_dir, "events"))
    sinks.run_available(sessions.gather_sessions(records, work, f"{work}/checkpoint"))
    pairs = sessions.read_pairs(spark, work)
    return pairs.select("serial_num", "terminal_id", F.col("start_ms").alias("open_ms"), F.col("end_ms").alias("close_ms"))


@query(
    "stream_open_carryover",
    f"""WITH {SESSIONS_SQL}
SELECT serial_num, terminal_id, start_ms, end_ms, CASE WHEN is_closed THEN 'closed' ELSE 'open' END AS state
FROM bounds""",
)
def stream_open_carryover(spark, sf_dir):
    """Five periods of log records arrive in turn, with a compaction on the way."""
    work = new_dir(spark, "carry")
    period = F.floor((F.dayofmonth("ts") - 1) / 6)
    slices = [period == i for i in range(4)] + [period >= 4]

    def start(events):
        return sessions.gather_sessions(records_of(events), work, f"{work}/checkpoint")

    inbox = new_dir(spark, "inbox")
    _arrivals(spark, sf_dir, slices[:3], start, inbox)
    sessions.compact_sessions(spark, work)
    _arrivals(spark, sf_dir, slices[3:], start, inbox)
    columns = ["serial_num", "terminal_id", "start_ms", "end_ms"]
    closed = sessions.read_pairs(spark, work).select(*columns, F.lit("closed").alias("state"))
    return closed.unionByName(sessions.read_carry(spark, work).select(*columns, F.lit("open").alias("state")))


# ---- route records -----------------------------------------------------------------------


@query("stream_route_project", KEY_SQL)
def stream_route_project(spark, sf_dir):
    return _collect_appends(spark, route_ops.project_key(routes_of(table_stream(spark, sf_dir, "lineitem"))))


@query(
    "stream_zone_half_hour_counts",
    f"""WITH {ROUTES_SQL}
SELECT zone_code, strftime(time_bucket(INTERVAL 30 MINUTE, bar_scan_tm), '%Y%m%d%H%M') AS half_hour, count(*) AS arrivals
FROM routes WHERE time_bucket(INTERVAL 30 MINUTE, bar_scan_tm) + INTERVAL 30 MINUTE
  <= (SELECT max(bar_scan_tm) - INTERVAL 10 MINUTE FROM routes) GROUP BY ALL""",
)
def stream_zone_half_hour_counts(spark, sf_dir):
    """Every scan comes twice and counts once; a half hour comes out when the watermark has passed it."""
    scans = routes_of(table_stream(spark, sf_dir, "lineitem"))
    return _collect_appends(spark, metrics.zone_arrivals(scans.unionByName(scans)))


@query(
    "stream_console",
    f"""WITH {ROUTES_SQL}
SELECT bar_record_id || '_' || waybill_no AS route_key, zone_code FROM routes ORDER BY route_key, zone_code LIMIT 10""",
)
def stream_console(spark, sf_dir):
    """What the console would show: the first rows of a micro-batch."""
    work = new_dir(spark, "preview")
    keys = route_ops.project_key(routes_of(table_stream(spark, sf_dir, "lineitem")))
    sinks.run_available(sinks.preview(keys, ["route_key", "zone_code"], f"{work}/out", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/out").select("route_key", "zone_code")
