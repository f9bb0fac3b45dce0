"""Connection-log metrics and session pairing."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.operators import sessions as ops
from telemetra.plans.inputs import AS_OF, AS_OF_BUCKET_SQL, LOG_SQL, SESSIONS_SQL, log_records
from telemetra.plans.registry import query


def _status_sql(status: int, name: str) -> str:
    return f"""WITH {LOG_SQL}
SELECT terminal_id, time_id, count(*) AS {name} FROM records WHERE online_status = {status}
GROUP BY terminal_id, time_id"""


# Seconds per bucket of the intervals in ``spans(terminal_id, s, e, last_bucket)``.
SPLIT_SQL = """
split AS (
  SELECT terminal_id, s, e, unnest(generate_series(s - s % 600000, last_bucket, 600000)) AS b FROM spans
),
durations AS (
  SELECT terminal_id, substr(strftime(make_timestamp(b * 1000), '%Y%m%d%H%M'), 1, 11) AS time_id,
         CAST(sum((least(e, b + 600000) - greatest(s, b)) // 1000) AS BIGINT) AS duration_seconds
  FROM split GROUP BY terminal_id, b
)"""

_PAIR_SPANS = "SELECT terminal_id, start_ms AS s, end_ms AS e, end_ms - end_ms % 600000 AS last_bucket FROM bounds WHERE is_closed"
_OPEN_SPANS = f"""SELECT terminal_id, start_ms AS s, {AS_OF_BUCKET_SQL} + 600000 AS e, {AS_OF_BUCKET_SQL} AS last_bucket
  FROM bounds WHERE NOT is_closed AND online_status = 1 AND start_ms < {AS_OF_BUCKET_SQL} + 600000"""


def _duration_sql(spans: str) -> str:
    return f"WITH {SESSIONS_SQL}, spans AS ({spans}), {SPLIT_SQL} SELECT * FROM durations"


TOTAL_SPANS = f"{_PAIR_SPANS} UNION ALL {_OPEN_SPANS}"

LOG_LONG_SQL = f"""{SESSIONS_SQL}, spans AS ({TOTAL_SPANS}), {SPLIT_SQL},
log_long AS (
  SELECT terminal_id, time_id, 'gpsLogConnectNum' AS metric, CAST(count(*) AS DOUBLE) AS value
  FROM records WHERE online_status = 1 GROUP BY terminal_id, time_id
  UNION ALL
  SELECT terminal_id, time_id, 'gpsLogCloseNum', CAST(count(*) AS DOUBLE)
  FROM records WHERE online_status = 0 GROUP BY terminal_id, time_id
  UNION ALL
  SELECT terminal_id, time_id, 'gpsLogConnectionDuration', CAST(duration_seconds AS DOUBLE) FROM durations
)"""


@query("log_connect_num", _status_sql(1, "connect_num"))
def log_connect_num(spark, sf_dir):
    return ops.connect_num(log_records(spark, sf_dir))


@query("log_close_num", _status_sql(0, "close_num"))
def log_close_num(spark, sf_dir):
    return ops.close_num(log_records(spark, sf_dir))


@query(
    "session_pair",
    f"WITH {SESSIONS_SQL} SELECT serial_num, terminal_id, start_ms, end_ms, record_count FROM bounds WHERE is_closed",
)
def session_pair(spark, sf_dir):
    return ops.pair_sessions(log_records(spark, sf_dir))


@query("session_duration_same_bucket", _duration_sql(f"{_PAIR_SPANS} AND start_ms // 600000 = end_ms // 600000"))
def session_duration_same_bucket(spark, sf_dir):
    return ops.duration_same_bucket(log_records(spark, sf_dir))


@query("session_duration_cross_bucket", _duration_sql(f"{_PAIR_SPANS} AND start_ms // 600000 <> end_ms // 600000"))
def session_duration_cross_bucket(spark, sf_dir):
    return ops.duration_cross_bucket(log_records(spark, sf_dir))


@query("session_duration_open", _duration_sql(_OPEN_SPANS))
def session_duration_open(spark, sf_dir):
    return ops.duration_open(log_records(spark, sf_dir), AS_OF)


@query("session_duration_total", _duration_sql(TOTAL_SPANS))
def session_duration_total(spark, sf_dir):
    return ops.duration_total(log_records(spark, sf_dir), AS_OF)


@query("log_metrics_long", f"WITH {LOG_LONG_SQL} SELECT * FROM log_long")
def log_metrics_long(spark, sf_dir):
    return ops.metrics_long(log_records(spark, sf_dir), AS_OF)


@query(
    "bucket_series",
    f"""WITH {SESSIONS_SQL}
SELECT serial_num, substr(strftime(make_timestamp(b * 1000), '%Y%m%d%H%M'), 1, 11) AS time_id
FROM (
  SELECT serial_num, unnest(generate_series(start_ms - start_ms % 600000, end_ms - end_ms % 600000, 600000)) AS b
  FROM bounds WHERE is_closed
)""",
)
def bucket_series(spark, sf_dir):
    pairs = ops.pair_sessions(log_records(spark, sf_dir))
    return ops.bucket_series(pairs, F.col("end_ms"), F.col("start_ms"), ["serial_num"])


UNPAIRED_SQL = f"""WITH {SESSIONS_SQL}
SELECT serial_num, terminal_id, start_ms AS ms, online_status FROM bounds WHERE NOT is_closed"""


@query("session_unpaired", UNPAIRED_SQL)
def session_unpaired(spark, sf_dir):
    single = ops.unpaired_sessions(log_records(spark, sf_dir))
    return single.select("serial_num", "terminal_id", F.unix_millis("ts").alias("ms"), "online_status")


@query(
    "log_requeue_unpaired",
    f"""WITH {SESSIONS_SQL}
SELECT 'serialNum:' || serial_num || ',terminalId:' || terminal_id || ',time:' || CAST(start_ms AS VARCHAR)
       || ',online:' || CAST(online_status AS VARCHAR) || ',serverIp:111.111.111.111' AS value
FROM bounds WHERE NOT is_closed""",
)
def log_requeue_unpaired(spark, sf_dir):
    return ops.requeue_lines(log_records(spark, sf_dir))


SELF_JOIN_SQL = f"""WITH {LOG_SQL}
SELECT o.serial_num, o.terminal_id, least(o.open_ms, c.close_ms) AS open_ms, greatest(o.open_ms, c.close_ms) AS close_ms
FROM (SELECT serial_num, terminal_id, min(ms) AS open_ms FROM records WHERE online_status = 1 GROUP BY ALL) o
JOIN (SELECT serial_num, terminal_id, max(ms) AS close_ms FROM records WHERE online_status = 0 GROUP BY ALL) c
  ON o.serial_num = c.serial_num AND o.terminal_id = c.terminal_id"""


@query("session_self_join", SELF_JOIN_SQL)
def session_self_join(spark, sf_dir):
    return ops.pair_by_join(log_records(spark, sf_dir))
