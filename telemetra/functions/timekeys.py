"""Wall-clock keys and bucket bounds. The session time zone is the zone of every key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from telemetra.functions.numbers import whole_div
from telemetra.schemas import BUCKET_MILLIS, BUCKET_SECONDS, DAY_KEY, HOUR_KEY, TEN_MINUTE_KEY

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_FORMAT = "yyyyMMddHHmmss"


def millis_of(ts: Column) -> Column:
    return F.unix_millis(ts)


def bucket_seconds(ts: Column) -> Column:
    """Start of the ten-minute bucket as epoch seconds: a cheap long to group by.

    Zone offsets are multiples of ten minutes, so epoch buckets and wall-clock buckets agree.
    """
    seconds = F.unix_seconds(ts)
    return seconds - F.pmod(seconds, F.lit(BUCKET_SECONDS))


def bucket_start_ms(ms: Column) -> Column:
    return ms - F.pmod(ms, F.lit(BUCKET_MILLIS))


def bucket_end_ms(ms: Column) -> Column:
    return bucket_start_ms(ms) + F.lit(BUCKET_MILLIS)


def time_id(ts: Column, length: int = TEN_MINUTE_KEY) -> Column:
    """Key text of a timestamp: 11 characters per ten minutes, 10 per hour, 8 per day."""
    return F.substring(F.date_format(ts, "yyyyMMddHHmm"), 1, length)


def time_id_of_seconds(seconds: Column, length: int = TEN_MINUTE_KEY) -> Column:
    return time_id(F.timestamp_seconds(seconds), length)


def time_id_of_millis(ms: Column, length: int = TEN_MINUTE_KEY) -> Column:
    return time_id(F.timestamp_millis(ms), length)


def parent_key(key: Column, length: int) -> Column:
    """Hour (10) or day (8) key of a finer key: keys of one zone nest as prefixes."""
    return F.substring(key, 1, length)


def previous_hour_key(as_of: Column) -> Column:
    return time_id(as_of - F.expr("INTERVAL 1 HOUR"), HOUR_KEY)


def previous_day_key(as_of: Column) -> Column:
    return time_id(as_of - F.expr("INTERVAL 24 HOUR"), DAY_KEY)


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def parse_seconds_text(text: Column, pattern: str = SECOND_FORMAT) -> Column:
    """Timestamp of formatted text, null when it does not parse."""
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_point_time(text: Column) -> Column:
    """Point time in either format: longer than 13 characters is date text, else epoch millis."""
    text = F.trim(text)
    as_date = parse_seconds_text(F.substring(text, 1, 19))
    as_millis = F.timestamp_millis(digits_only(text).try_cast("bigint"))
    return F.when(F.length(text) > 13, as_date).otherwise(as_millis)


def start_of(unit: str, ts: Column) -> Column:
    """Start of the minute, hour, day, week (Monday) or month the timestamp is in."""
    return F.date_trunc(unit, ts)


def next_start_of(unit: str, ts: Column) -> Column:
    step = {
        "minute": "INTERVAL 1 MINUTE",
        "hour": "INTERVAL 1 HOUR",
        "day": "INTERVAL 1 DAY",
        "week": "INTERVAL 7 DAY",
        "month": "INTERVAL 1 MONTH",
    }[unit]
    return F.date_trunc(unit, ts) + F.expr(step)


def date_hour(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to ``yyyy-MM-dd_HH``."""
    day = F.split_part(text, F.lit(" "), F.lit(1))
    hour = F.split_part(F.split_part(text, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))
    return F.concat(day, F.lit("_"), hour)


def is_before(left: Column, right: Column) -> Column:
    """Compare two time texts; false when either is bad."""
    return F.coalesce(parse_seconds_text(left) < parse_seconds_text(right), F.lit(False))


def is_after(left: Column, right: Column) -> Column:
    return F.coalesce(parse_seconds_text(left) > parse_seconds_text(right), F.lit(False))


def minus_seconds(left: Column, right: Column) -> Column:
    """Whole seconds from right to left; 0 when either text is bad."""
    gap = F.unix_seconds(parse_seconds_text(left)) - F.unix_seconds(parse_seconds_text(right))
    return F.coalesce(gap, F.lit(0).cast("bigint"))


def seconds_between(ms_a: Column, ms_b: Column) -> Column:
    """Whole seconds between two epoch-millis values, order free, truncated."""
    return whole_div(F.abs(ms_a - ms_b), 1000)
