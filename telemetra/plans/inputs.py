"""Telemetry frames derived from the test tables, and the same derivation as SQL.

Every mapping is row-local (no shuffle, no window), so a user or terminal that owns a third of
all events costs nothing extra. The SQL texts are ``WITH`` entries the oracle queries start from.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.sources.lines import format_log_lines

AS_OF = datetime(2024, 1, 31, 0, 5, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


# ---- GPS points --------------------------------------------------------------------------


def points_of(events: DataFrame, *extra: Column) -> DataFrame:
    return events.select(
        (F.col("user_id") % 2).cast("string").alias("terminal_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_id") % 3).cast("double").alias("speed"),
        (_k() % 8 - 1).alias("satellite_num"),
        (F.col("event_type") != "error").cast("int").alias("online_status"),
        *extra,
    )


def gps_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_of(table(spark, sf_dir, "events"))


def gps_points_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points with one terminal per user."""
    user = F.col("user_id").cast("string").alias("user")
    return points_of(table(spark, sf_dir, "events"), user).drop("terminal_id").withColumnRenamed("user", "terminal_id")


POINTS_SQL = """
points AS (
  SELECT CAST(user_id % 2 AS VARCHAR) AS terminal_id, ts,
         substr(strftime(ts, '%Y%m%d%H%M'), 1, 11) AS time_id,
         epoch_us(ts) // 1000 AS ms,
         CAST(event_id % 3 AS DOUBLE) AS speed,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 - 1 AS satellite_num,
         CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS online_status,
         user_id % 3 AS writer
  FROM events
)"""


def wide_sql(source: str = "points", keys: str = "terminal_id, time_id", extra: str = "") -> str:
    """The nine metrics per key over ``source``, N = 15."""
    return f"""
counted AS (
  SELECT {keys}, count(*) AS n,
         count(*) FILTER (WHERE online_status = 1) AS onl,
         count(*) FILTER (WHERE online_status = 0) AS offl,
         count(*) FILTER (WHERE satellite_num > 0 AND satellite_num < 4) AS weak,
         count(*) FILTER (WHERE satellite_num = -1) AS closed,
         count(*) FILTER (WHERE speed = 0) AS still,
         count(*) FILTER (WHERE online_status = 1 AND satellite_num >= 4) AS normal
         {extra}
  FROM {source} GROUP BY {keys}
),
totals AS (SELECT *, CASE WHEN n > 3 THEN 15 ELSE 3 END AS total FROM counted),
wide AS (
  SELECT * EXCLUDE (n, onl, offl, weak, closed, still, normal, total),
         CAST(total // 15 AS BIGINT) AS gps_frequent, CAST(total AS BIGINT) AS gps_total_num,
         onl AS gps_online_total, weak AS gps_weak_num, closed AS gps_not_open_num,
         still AS gps_zero_speed_num, offl AS gps_offline_total, normal AS gps_normal_num,
         CASE WHEN onl > 0 THEN
           ((200 * least(total, onl) + greatest(total, onl)) // (2 * greatest(total, onl))) / 100.0::DOUBLE
         END AS gps_online_percent
  FROM totals
)"""


WIDE_SQL = POINTS_SQL + "," + wide_sql()

_LONG_METRICS = """['gpsFrequent','gpsTotalNum','gpsOnlineTotal','gpsWeakNum','gpsNotOpenNum',
            'zeroSpeedNum','gpsOfflineTotal','gpsNormalNum','gpsOnlinePercent']"""


def long_sql(ids: str, kind: str, name: str, source: str = "wide") -> str:
    """Present metrics of the wide rows as rows; a count of zero has none."""
    columns = ", ".join(
        f"CAST({c} AS {kind})"
        for c in (
            "gps_frequent", "gps_total_num", "nullif(gps_online_total, 0)", "nullif(gps_weak_num, 0)",
            "nullif(gps_not_open_num, 0)", "nullif(gps_zero_speed_num, 0)", "nullif(gps_offline_total, 0)",
            "nullif(gps_normal_num, 0)", "gps_online_percent",
        )
    )
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT {ids}, unnest({_LONG_METRICS}) AS metric, unnest([{columns}]) AS value FROM {source}
  ) WHERE value IS NOT NULL
)"""


WIDE_BY_USER_SQL = WIDE_SQL.replace("CAST(user_id % 2 AS VARCHAR)", "CAST(user_id AS VARCHAR)")

GPS_LONG_SQL = WIDE_SQL + "," + long_sql("terminal_id, time_id", "DOUBLE", "gps_long")


# ---- connection log ----------------------------------------------------------------------


def _stride() -> Column:
    """Distance between the event that connects and the event that closes a session."""
    kind = F.col("event_id") % 4
    return F.when(kind == 0, 4).when(kind == 1, 32).when(kind == 2, 256).otherwise(1024)


def records_of(events: DataFrame) -> DataFrame:
    """Two events a stride apart are one session; strides give sessions from minutes to days.

    The event whose partner lies past the end of the table stays an open session.
    """
    half = F.expr("event_id div stride") % 2
    serial = F.col("event_id") - half * F.col("stride")
    return (
        events.select("event_id", "ts", _stride().alias("stride"))
        .select(
            serial.cast("string").alias("serial_num"),
            (serial % 97).cast("string").alias("terminal_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            (1 - half).cast("int").alias("online_status"),
        )
    )


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(table(spark, sf_dir, "events"))


LOG_SQL = """
strides AS (
  SELECT event_id, ts, event_type, epoch_us(ts) // 1000 AS ms,
         CASE event_id % 4 WHEN 0 THEN 4 WHEN 1 THEN 32 WHEN 2 THEN 256 ELSE 1024 END AS stride
  FROM events
),
halves AS (SELECT *, (event_id // stride) % 2 AS half FROM strides),
records AS (
  SELECT CAST(event_id - half * stride AS VARCHAR) AS serial_num,
         CAST((event_id - half * stride) % 97 AS VARCHAR) AS terminal_id,
         ts, ms, CAST(1 - half AS INTEGER) AS online_status,
         substr(strftime(ts, '%Y%m%d%H%M'), 1, 11) AS time_id
  FROM halves
)"""

SESSIONS_SQL = LOG_SQL + """,
states AS (
  SELECT serial_num, terminal_id, count(*) AS record_count,
         min(ms) FILTER (WHERE online_status = 1) AS open_ms, max(ms) FILTER (WHERE online_status = 0) AS close_ms
  FROM records GROUP BY serial_num, terminal_id
),
bounds AS (
  SELECT serial_num, terminal_id, record_count,
         coalesce(least(open_ms, close_ms), open_ms, close_ms) AS start_ms,
         coalesce(greatest(open_ms, close_ms), open_ms, close_ms) AS end_ms,
         CASE WHEN open_ms IS NULL THEN 0 ELSE 1 END AS online_status,
         open_ms IS NOT NULL AND close_ms IS NOT NULL AS is_closed
  FROM states
)"""

# The bucket AS_OF lies in starts at 2024-01-31 00:00:00.
AS_OF_BUCKET_SQL = "epoch_ms(TIMESTAMP '2024-01-31 00:00:00')"


# ---- raw lines ---------------------------------------------------------------------------


def _point_text(i: Column) -> Column:
    """Ten comma fields; even points carry date text, odd ones epoch millis."""
    at = F.col("t") + F.make_interval(secs=i * 5)
    time_text = F.when(
        (F.col("k") + i) % 2 == 0, F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(".7"))
    ).otherwise(F.unix_millis(at).cast("string"))
    return F.concat_ws(
        ",",
        time_text,
        F.lit("north"),
        F.lit("east"),
        F.concat(((F.col("event_id") + i) % 3).cast("string"), F.lit(".5")),
        F.lit("a"),
        F.lit("b"),
        ((F.col("k") + i) % 8 - 1).cast("string"),
        F.lit("c"),
        F.lit("d"),
        (F.col("event_type") != "error").cast("int").cast("string"),
    )


def gps_lines_of(events: DataFrame) -> DataFrame:
    """One envelope of one to three points per event; signups send another command, views come
    wrapped in quotes."""
    points = F.transform(F.sequence(F.lit(0), F.col("k") % 3), _point_text)
    command = F.when(F.col("event_type") == "signup", "410").otherwise("420")
    line = F.concat(
        F.lit("from-"), (F.col("user_id") % 9).cast("string"),
        F.lit('@@@{"terminalId":"'), (F.col("user_id") % 2).cast("string"),
        F.lit('","event":'), F.col("event_id").cast("string"),
        F.lit(',"cmdId":"'), command,
        F.lit('","message":"'), F.translate(F.base64(F.array_join(points, ";").cast("binary")), "\r\n", ""),
        F.lit('"}'),
    )
    quoted = F.when(F.col("event_type") == "view", F.concat(F.lit('"'), line, F.lit('"'))).otherwise(line)
    return events.select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("t"), _k().alias("k")
    ).select(quoted.alias("value"))


def gps_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gps_lines_of(table(spark, sf_dir, "events"))


GPS_LINE_POINTS_SQL = """
line_points AS (
  SELECT event_id, event_type, user_id, i,
         CAST(user_id % 2 AS VARCHAR) AS terminal_id,
         date_trunc('milliseconds', ts) + to_seconds(i * 5) AS pts,
         (k + i) % 2 = 0 AS as_date, (event_id + i) % 3 + 0.5::DOUBLE AS speed,
         CAST((k + i) % 8 - 1 AS INTEGER) AS satellite_num,
         CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS online_status
  FROM (
    SELECT *, unnest(range(0, k % 3 + 1)) AS i
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
  )
),
timed_points AS (
  SELECT *, CASE WHEN as_date THEN strftime(pts, '%Y-%m-%d %H:%M:%S') || '.7'
                 ELSE CAST(epoch_us(pts) // 1000 AS VARCHAR) END AS raw_time,
         substr(strftime(pts, '%Y%m%d%H%M'), 1, 11) AS time_id
  FROM line_points
)"""

GPS_LINES_SQL = GPS_LINE_POINTS_SQL + """,
payloads AS (
  SELECT event_id, event_type, user_id,
         string_agg(raw_time || ',north,east,' || CAST(speed AS VARCHAR) || ',a,b,'
                    || CAST(satellite_num AS VARCHAR) || ',c,d,' || CAST(online_status AS VARCHAR),
                    ';' ORDER BY i) AS payload
  FROM timed_points GROUP BY event_id, event_type, user_id
),
clean_lines AS (
  SELECT event_type,
         'from-' || CAST(user_id % 9 AS VARCHAR) || '@@@{"terminalId":"' || CAST(user_id % 2 AS VARCHAR)
         || '","event":' || CAST(event_id AS VARCHAR)
         || ',"cmdId":"' || CASE WHEN event_type = 'signup' THEN '410' ELSE '420' END
         || '","message":"' || base64(encode(payload)) || '"}' AS value
  FROM payloads
)"""


def log_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line per log record, and a line that is not a log record for every error event."""
    events = table(spark, sf_dir, "events")
    lines = format_log_lines(records_of(events), F.concat(F.lit("10.0.0."), F.col("terminal_id")))
    noise = events.where(F.col("event_type") == "error").select(
        F.concat(F.lit("heartbeat,terminalId:"), F.col("user_id").cast("string")).alias("value")
    )
    return lines.unionByName(noise)


# ---- key=value lines ---------------------------------------------------------------------


def kv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``data`` and ``param`` texts; some fields are missing, empty or repeated."""
    k, kind = _k(), F.col("event_type")
    age = F.when(kind == "error", F.lit("age=")).otherwise(F.concat(F.lit("age="), k.cast("string")))
    data = F.concat(
        F.when(kind == "purchase", F.lit("")).otherwise(F.concat(age, F.lit("|"))),
        F.lit("kinds="), kind, F.lit(","), (F.col("user_id") % 5).cast("string"),
        F.lit("|city=c"), (k % 7).cast("string"), F.lit("|city=other"),
    )
    param = F.concat(
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("startAge="), (k % 40).cast("string"), F.lit("|"))),
        F.lit("endAge=60"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.lit("|kinds=click,3,signup")),
        F.when(k % 3 == 0, F.lit("|city=")).otherwise(F.lit("|city=c3")),
    )
    return table(spark, sf_dir, "events").select("event_id", data.alias("data"), param.alias("param"))


KV_SQL = """
kv AS (
  SELECT event_id, event_type, k,
         CASE WHEN event_type NOT IN ('purchase', 'error') THEN k END AS age,
         event_type AS kind, CAST(user_id % 5 AS VARCHAR) AS kind_no,
         'c' || CAST(k % 7 AS VARCHAR) AS city,
         CASE WHEN k % 4 <> 0 THEN k % 40 END AS start_age
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


# ---- route records -----------------------------------------------------------------------


def routes_of(lineitem: DataFrame) -> DataFrame:
    """Scan records of parcels; some have no main waybill and some no scan time."""
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    shipped = F.col("l_shipdate").cast("timestamp")
    return lineitem.select(
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("data_status"),
        (order % 10).cast("int").alias("status"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("M"), order.cast("string"))).alias("main_waybill_no"),
        line.cast("bigint").alias("ordinal"),
        shipped.alias("create_tm"),
        part.cast("string").alias("bar_record_id"),
        order.cast("string").alias("waybill_no"),
        F.concat(F.lit("Z"), F.col("l_suppkey").cast("string")).alias("zone_code"),
        F.col("l_returnflag").alias("op_code"),
        F.concat(F.lit("C"), (part % 50).cast("string")).alias("contnr_code"),
        F.col("l_linestatus").alias("op_attach_info"),
        F.lit("30").alias("obj_type_code"),
        F.when(line != 7, shipped + F.make_interval(mins=(part % 1440).cast("int"))).alias("bar_scan_tm"),
        F.concat(F.lit("Z"), (F.col("l_suppkey") + 1).cast("string")).alias("dest_zone_code"),
        (F.col("l_quantity") > 40).alias("original_flag"),
    )


def route_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes_of(table(spark, sf_dir, "lineitem"))


ROUTES_SQL = """
routes AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS data_status,
         CAST(l_orderkey % 10 AS INTEGER) AS status,
         CASE WHEN l_returnflag <> 'N' THEN 'M' || CAST(l_orderkey AS VARCHAR) END AS main_waybill_no,
         CAST(l_linenumber AS BIGINT) AS ordinal, l_shipdate AS create_tm,
         CAST(l_partkey AS VARCHAR) AS bar_record_id, CAST(l_orderkey AS VARCHAR) AS waybill_no,
         'Z' || CAST(l_suppkey AS VARCHAR) AS zone_code, l_returnflag AS op_code,
         'C' || CAST(l_partkey % 50 AS VARCHAR) AS contnr_code, l_linestatus AS op_attach_info,
         '30' AS obj_type_code,
         CASE WHEN l_linenumber <> 7 THEN l_shipdate + to_minutes(l_partkey % 1440) END AS bar_scan_tm,
         'Z' || CAST(l_suppkey + 1 AS VARCHAR) AS dest_zone_code, l_quantity > 40 AS original_flag
  FROM lineitem
)"""
