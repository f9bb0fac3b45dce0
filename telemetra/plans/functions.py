"""Column functions, one query per family."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import numbers, text, timekeys
from telemetra.plans.inputs import KV_SQL, kv_lines, table
from telemetra.plans.registry import query

_EVENTS_SQL = "SELECT *, epoch_us(ts) // 1000 AS ms, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"


def _events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("ms", F.unix_millis("ts"))


def _k():
    return F.get_json_object("props", "$.k").cast("int")


# ---- time --------------------------------------------------------------------------------


@query(
    "time_bucket_keys",
    f"""SELECT event_id, substr(strftime(make_timestamp((ms // 1000) * 1000000), '%Y%m%d%H%M%S'), 1, 11) AS key_of_seconds,
       substr(strftime(make_timestamp(ms * 1000), '%Y%m%d%H%M%S'), 1, 11) AS key_of_millis,
       substr(strftime(ts, '%Y%m%d%H%M%S'), 1, 11) AS key_as_of
FROM ({_EVENTS_SQL})""",
)
def time_bucket_keys(spark, sf_dir):
    seconds_text = F.unix_seconds("ts").cast("string")
    millis_text = F.col("ms").cast("string")
    return _events(spark, sf_dir).select(
        "event_id",
        timekeys.time_id_of_seconds(seconds_text.cast("bigint")).alias("key_of_seconds"),
        timekeys.time_id_of_millis(timekeys.digits_only(millis_text).cast("bigint")).alias("key_of_millis"),
        timekeys.time_id(F.col("ts")).alias("key_as_of"),
    )


@query(
    "time_bucket_bounds",
    f"SELECT event_id, ms - ms % 600000 AS start_ms, ms - ms % 600000 + 600000 AS end_ms FROM ({_EVENTS_SQL})",
)
def time_bucket_bounds(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        timekeys.bucket_start_ms(F.col("ms")).alias("start_ms"),
        timekeys.bucket_end_ms(F.col("ms")).alias("end_ms"),
    )


@query(
    "time_prev_period_keys",
    """SELECT event_id, strftime(ts - INTERVAL 1 HOUR, '%Y%m%d%H') AS last_hour,
       strftime(ts - INTERVAL 24 HOUR, '%Y%m%d') AS last_day
FROM events""",
)
def time_prev_period_keys(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        timekeys.previous_hour_key(F.col("ts")).alias("last_hour"),
        timekeys.previous_day_key(F.col("ts")).alias("last_day"),
    )


@query(
    "time_calendar_bounds",
    """SELECT event_id,
       epoch_us(date_trunc('minute', ts)) // 1000000 + 60 AS next_minute_s,
       epoch_us(date_trunc('hour', ts)) // 1000000 + 3600 AS next_hour_s,
       (epoch_us(date_trunc('hour', ts)) // 1000000 + 3600) * 1000 AS next_hour_ms,
       epoch_us(date_trunc('hour', ts)) // 1000 AS this_hour_ms,
       epoch_us(date_trunc('day', ts)) // 1000000 + 86400 AS next_day_s,
       epoch_us(date_trunc('week', ts)) // 1000000 + 604800 AS next_week_s,
       epoch_us(date_trunc('month', ts) + INTERVAL 1 MONTH) // 1000000 AS next_month_s,
       epoch_us(date_trunc('month', ts)) // 1000000 AS this_month_s,
       strftime(date_trunc('week', ts), '%Y-%m-%d') AS this_monday,
       epoch_us(date_trunc('second', ts)) // 1000 AS now_ms
FROM events""",
)
def time_calendar_bounds(spark, sf_dir):
    ts = F.col("ts")
    return _events(spark, sf_dir).select(
        "event_id",
        F.unix_seconds(timekeys.next_start_of("minute", ts)).alias("next_minute_s"),
        F.unix_seconds(timekeys.next_start_of("hour", ts)).alias("next_hour_s"),
        F.unix_millis(timekeys.next_start_of("hour", ts)).alias("next_hour_ms"),
        F.unix_millis(timekeys.start_of("hour", ts)).alias("this_hour_ms"),
        F.unix_seconds(timekeys.next_start_of("day", ts)).alias("next_day_s"),
        F.unix_seconds(timekeys.next_start_of("week", ts)).alias("next_week_s"),
        F.unix_seconds(timekeys.next_start_of("month", ts)).alias("next_month_s"),
        F.unix_seconds(timekeys.start_of("month", ts)).alias("this_month_s"),
        F.date_format(timekeys.start_of("week", ts), "yyyy-MM-dd").alias("this_monday"),
        F.unix_millis(timekeys.start_of("second", ts)).alias("now_ms"),
    )


@query(
    "time_format_parse",
    """WITH t AS (
  SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 'no time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS txt
  FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
       strftime(ts, '%Y%m%d') AS date_key, strftime(ts, '%Y%m%d%H%M') AS minute_key,
       epoch_us(try_strptime(txt, '%Y-%m-%d %H:%M:%S')) // 1000 AS parsed_ms,
       epoch_us(date_trunc('day', ts)) // 1000 AS parsed_date_key_ms,
       epoch_us(date_trunc('second', ts)) // 1000 AS compact_ms,
       strftime(ts, '%Y%m%d%H%M%S') AS compact_of_seconds,
       strftime(ts, '%Y%m%d%H%M%S') AS compact_of_millis,
       strftime(ts, '%Y-%m-%d_%H') AS date_hour,
       strftime(ts, '%Y-%m-%d') AS today, strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday
FROM t""",
)
def time_format_parse(spark, sf_dir):
    ts = F.col("ts")
    time_text = F.date_format(ts, timekeys.SECOND_FORMAT)
    compact = F.date_format(ts, timekeys.COMPACT_FORMAT)
    given = F.when(F.col("event_type") == "error", F.lit("no time")).otherwise(time_text)
    return _events(spark, sf_dir).select(
        "event_id",
        F.date_format(ts, "yyyy-MM-dd").alias("date_text"),
        time_text.alias("time_text"),
        timekeys.time_id(ts, 8).alias("date_key"),
        timekeys.time_id(ts, 12).alias("minute_key"),
        F.unix_millis(timekeys.parse_seconds_text(given)).alias("parsed_ms"),
        F.unix_millis(timekeys.parse_seconds_text(timekeys.time_id(ts, 8), "yyyyMMdd")).alias("parsed_date_key_ms"),
        F.unix_millis(timekeys.parse_seconds_text(compact, timekeys.COMPACT_FORMAT)).alias("compact_ms"),
        F.date_format(F.timestamp_seconds(F.unix_seconds(ts)), timekeys.COMPACT_FORMAT).alias("compact_of_seconds"),
        F.date_format(F.timestamp_millis(F.col("ms")), timekeys.COMPACT_FORMAT).alias("compact_of_millis"),
        timekeys.date_hour(time_text).alias("date_hour"),
        F.date_format(ts, "yyyy-MM-dd").alias("today"),
        F.date_format(ts - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd").alias("yesterday"),
    )


@query(
    "time_compare",
    f"""WITH t AS (
  SELECT event_id, ms, k, date_trunc('second', ts) AS a,
         CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) + to_seconds(k * 7 - 300) END AS b
  FROM ({_EVENTS_SQL}))
SELECT event_id, coalesce(a < b, false) AS is_before, coalesce(a > b, false) AS is_after,
       coalesce((epoch_us(a) - epoch_us(b)) // 1000000, 0) AS minus_seconds,
       CAST(abs(k * 777 - 30000) // 1000 AS BIGINT) AS gap_seconds,
       ms // 1000 AS now_s
FROM t""",
)
def time_compare(spark, sf_dir):
    a = F.date_format("ts", timekeys.SECOND_FORMAT)
    shifted = F.date_format(F.col("ts") + F.make_interval(secs=_k() * 7 - 300), timekeys.SECOND_FORMAT)
    b = F.when(F.col("event_type") == "error", F.lit("bad text")).otherwise(shifted)
    return _events(spark, sf_dir).select(
        "event_id",
        timekeys.is_before(a, b).alias("is_before"),
        timekeys.is_after(a, b).alias("is_after"),
        timekeys.minus_seconds(a, b).alias("minus_seconds"),
        timekeys.seconds_between(F.col("ms"), F.col("ms") + _k() * 777 - 30000).alias("gap_seconds"),
        F.unix_seconds("ts").alias("now_s"),
    )


# ---- numbers and text --------------------------------------------------------------------


@query(
    "num_functions",
    f"""SELECT event_id, CAST(round(CAST(value AS DECIMAL(28,9)), 1) AS DOUBLE) AS one_decimal,
       CAST(round(CAST(value / 7 AS DECIMAL(28,9)), 2) AS DOUBLE) AS two_decimals,
       CAST(k + user_id AS BIGINT) AS added,
       CASE WHEN k >= user_id THEN CAST(k AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END AS bigger,
       CASE WHEN k >= user_id THEN CAST(user_id AS VARCHAR) ELSE CAST(k AS VARCHAR) END AS smaller
FROM ({_EVENTS_SQL})""",
)
def num_functions(spark, sf_dir):
    a, b = _k().cast("string"), F.col("user_id").cast("string")
    return _events(spark, sf_dir).select(
        "event_id",
        numbers.format_double(F.col("value"), 1).alias("one_decimal"),
        numbers.format_double(F.col("value") / 7, 2).alias("two_decimals"),
        numbers.add_text_numbers(a, b).alias("added"),
        numbers.bigger_text_number(a, b).alias("bigger"),
        numbers.smaller_text_number(a, b).alias("smaller"),
    )


@query(
    "str_functions",
    f"""WITH t AS (
  SELECT event_id, event_type, value, k,
         CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '' WHEN 'click' THEN '  ' ELSE event_type END AS s
  FROM ({_EVENTS_SQL}))
SELECT event_id, s IS NULL OR s = '' AS is_empty, s IS NOT NULL AND s <> '' AS is_not_empty,
       s IS NULL OR trim(s) = '' AS is_nil,
       ',' || event_type || ',' AS trimmed_comma,
       CASE WHEN k BETWEEN 10 AND 99 THEN CAST(k AS VARCHAR) ELSE '0' || CAST(k AS VARCHAR) END AS two_digits,
       CAST(k AS VARCHAR) || '7' AS digits,
       CAST(k AS VARCHAR) AS before_dot
FROM t""",
)
def str_functions(spark, sf_dir):
    kind, k = F.col("event_type"), _k().cast("string")
    s = (
        F.when(kind == "error", F.lit(None).cast("string"))
        .when(kind == "view", F.lit(""))
        .when(kind == "click", F.lit("  "))
        .otherwise(kind)
    )
    return _events(spark, sf_dir).select(
        "event_id",
        text.is_empty(s).alias("is_empty"),
        text.is_not_empty(s).alias("is_not_empty"),
        text.is_nil(s).alias("is_nil"),
        text.trim_comma(F.concat(F.lit(",,"), kind, F.lit(",,"))).alias("trimmed_comma"),
        text.pad_two_digits(k).alias("two_digits"),
        timekeys.digits_only(F.concat(F.lit("-x"), k, F.lit(" km 7"))).alias("digits"),
        text.cut_at_dot(F.concat(k, F.lit(".5km.x")), "km").alias("before_dot"),
    )


@query(
    "hash_hex_functions",
    """SELECT doc_id, upper(md5(text)) AS md5_hex, upper(hex(encode(source))) AS source_hex,
       CAST(CASE WHEN u > 9223372036854775807 THEN u - 18446744073709551616 ELSE u END AS BIGINT) AS first_long
FROM (SELECT *, CAST(CAST('0x' || substr(md5(text), 1, 16) AS UBIGINT) AS HUGEINT) AS u FROM documents)""",
)
def hash_hex_functions(spark, sf_dir):
    digest = text.md5_upper(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        digest.alias("md5_hex"),
        text.bytes_to_hex(F.col("source").cast("binary")).alias("source_hex"),
        numbers.signed_long_of_hex(F.substring(digest, 1, 16)).alias("first_long"),
    )


@query(
    "map_entries_roundtrip",
    f"""SELECT event_id, unnest(['kind', 'ids']) AS key, unnest([[event_type, 'x'], [CAST(user_id AS VARCHAR), CAST(k AS VARCHAR)]])[1] AS first_value,
       unnest([[event_type, 'x'], [CAST(user_id AS VARCHAR), CAST(k AS VARCHAR)]])[2] AS second_value
FROM ({_EVENTS_SQL})""",
)
def map_entries_roundtrip(spark, sf_dir):
    original = F.create_map(
        F.lit("kind"), F.array(F.col("event_type"), F.lit("x")),
        F.lit("ids"), F.array(F.col("user_id").cast("string"), _k().cast("string")),
    )
    back = F.map_from_entries(F.map_entries(original))
    return _events(spark, sf_dir).select("event_id", F.explode(back).alias("key", "items")).select(
        "event_id", "key", F.get("items", F.lit(0)).alias("first_value"), F.get("items", F.lit(1)).alias("second_value")
    )


# ---- key=value lists ---------------------------------------------------------------------


@query(
    "kv_param_between",
    f"""WITH {KV_SQL}
SELECT event_id, start_age IS NULL OR coalesce(age BETWEEN start_age AND 60, false) AS accepted FROM kv""",
)
def kv_param_between(spark, sf_dir):
    accepted = text.kv_between(F.col("data"), "age", F.col("param"), "startAge", "endAge")
    return kv_lines(spark, sf_dir).select("event_id", accepted.alias("accepted"))


@query(
    "kv_param_in",
    f"""WITH {KV_SQL}
SELECT event_id, k % 5 = 0 OR kind IN ('click', '3', 'signup') OR kind_no IN ('click', '3', 'signup') AS accepted FROM kv""",
)
def kv_param_in(spark, sf_dir):
    accepted = text.kv_in(F.col("data"), "kinds", F.col("param"), "kinds")
    return kv_lines(spark, sf_dir).select("event_id", accepted.alias("accepted"))


@query(
    "kv_param_equal",
    f"WITH {KV_SQL} SELECT event_id, k % 3 = 0 OR city = 'c3' AS accepted FROM kv",
)
def kv_param_equal(spark, sf_dir):
    accepted = text.kv_equal(F.col("data"), "city", F.col("param"), "city")
    return kv_lines(spark, sf_dir).select("event_id", accepted.alias("accepted"))


@query(
    "kv_get_field",
    f"""WITH {KV_SQL}
SELECT event_id, CAST(age AS VARCHAR) AS age, kind || ',' || kind_no AS kinds, city, CAST(NULL AS VARCHAR) AS missing FROM kv""",
)
def kv_get_field(spark, sf_dir):
    return kv_lines(spark, sf_dir).select(
        "event_id", *[text.kv_get(F.col("data"), name).alias(name) for name in ("age", "kinds", "city", "missing")]
    )


@query(
    "kv_set_field",
    f"""WITH {KV_SQL}
SELECT event_id,
       CASE event_type WHEN 'purchase' THEN '' WHEN 'error' THEN 'age=|' ELSE 'age=' || CAST(age AS VARCHAR) || '|' END
       || 'kinds=' || kind || ',' || kind_no || '|city=here|city=other' AS city_set,
       CASE event_type WHEN 'purchase' THEN '' ELSE 'age=30|' END
       || 'kinds=' || kind || ',' || kind_no || '|city=' || city || '|city=other' AS age_set
FROM kv""",
)
def kv_set_field(spark, sf_dir):
    return kv_lines(spark, sf_dir).select(
        "event_id",
        text.kv_set(F.col("data"), "city", "here").alias("city_set"),
        text.kv_set(F.col("data"), "age", "30").alias("age_set"),
    )


@query(
    "json_array_first",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL
       ELSE CAST(user_id AS VARCHAR) END AS first_id
FROM events""",
)
def json_array_first(spark, sf_dir):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    ids = F.when(kind == "view", F.lit("[]")).otherwise(F.concat(F.lit('["'), user, F.lit('","9"]')))
    field = F.when(kind == "error", F.lit("other")).otherwise(F.lit("ids"))
    param = F.concat(F.lit('{"'), field, F.lit('":'), ids, F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", text.first_of_json_array(param, "ids").alias("first_id"))
