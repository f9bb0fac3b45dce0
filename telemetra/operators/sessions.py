"""Connection-log metrics: connects, closes and connected seconds per ten-minute bucket.

A session is the connect and the close record of one ``(serial_num, terminal_id)``. Records
are reduced to one row per session by a partial aggregation, so a session with any number of
repeated records never gathers in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.functions import timekeys
from telemetra.functions.numbers import whole_div
from telemetra.schemas import (
    BUCKET_MILLIS,
    BUCKET_SECONDS,
    LOG_CLOSE_NUM,
    LOG_CONNECT_NUM,
    LOG_CONNECTION_DURATION,
    REQUEUE_SERVER_IP,
)
from telemetra.sources.lines import format_log_lines

SESSION = ["serial_num", "terminal_id"]
KEYS = ["terminal_id", "time_id"]


def _status_count(records: DataFrame, status: int, name: str) -> DataFrame:
    bucket = timekeys.bucket_seconds(F.col("ts")).alias("bucket")
    return (
        records.where(F.col("online_status") == status)
        .groupBy("terminal_id", bucket)
        .agg(F.count(F.lit(1)).alias(name))
        .select("terminal_id", timekeys.time_id_of_seconds(F.col("bucket")).alias("time_id"), name)
    )


def connect_num(records: DataFrame) -> DataFrame:
    return _status_count(records, 1, "connect_num")


def close_num(records: DataFrame) -> DataFrame:
    return _status_count(records, 0, "close_num")


def status_counts(records: DataFrame) -> DataFrame:
    """Connects and closes side by side from one pass."""
    bucket = timekeys.bucket_seconds(F.col("ts")).alias("bucket")
    return (
        records.groupBy("terminal_id", bucket)
        .agg(
            F.count_if(F.col("online_status") == 1).alias("connect_num"),
            F.count_if(F.col("online_status") == 0).alias("close_num"),
        )
        .select(
            "terminal_id",
            timekeys.time_id_of_seconds(F.col("bucket")).alias("time_id"),
            "connect_num",
            "close_num",
        )
    )


STATE = ["open_ms", "close_ms", "record_count"]


def session_state(records: DataFrame) -> DataFrame:
    """One row per session: first connect, last close and number of records. States can be merged."""
    ms = timekeys.millis_of(F.col("ts"))
    return records.groupBy(*SESSION).agg(
        F.min(F.when(F.col("online_status") == 1, ms)).alias("open_ms"),
        F.max(F.when(F.col("online_status") == 0, ms)).alias("close_ms"),
        F.count_if(F.col("online_status").isin(0, 1)).alias("record_count"),
    )


def merged_states(states: DataFrame, *beside: Column) -> DataFrame:
    """States of parts of the records, in any order, as the state of all of them; ``beside`` are more aggregates."""
    return states.groupBy(*SESSION).agg(
        F.min("open_ms").alias("open_ms"),
        F.max("close_ms").alias("close_ms"),
        F.sum("record_count").alias("record_count"),
        *beside,
    )


def bounds_of(states: DataFrame) -> DataFrame:
    """Start, end and whether both a connect and a close are known. Copies of a record change nothing."""
    known = states.where(F.col("open_ms").isNotNull() | F.col("close_ms").isNotNull())
    return known.select(
        *SESSION,
        F.least("open_ms", "close_ms").alias("start_ms"),
        F.greatest("open_ms", "close_ms").alias("end_ms"),
        "record_count",
        F.col("open_ms").isNotNull().cast("int").alias("online_status"),
        (F.col("open_ms").isNotNull() & F.col("close_ms").isNotNull()).alias("is_closed"),
    )


def session_bounds(records: DataFrame) -> DataFrame:
    return bounds_of(session_state(records))


def pair_sessions(records: DataFrame) -> DataFrame:
    """Sessions with a connect and a close: the smaller instant opens, the bigger one closes."""
    return session_bounds(records).where("is_closed").select(*SESSION, "start_ms", "end_ms", "record_count")


def unpaired_sessions(records: DataFrame) -> DataFrame:
    """One record for every session that has only connects (the first) or only closes (the last)."""
    return (
        session_bounds(records)
        .where("not is_closed")
        .select(*SESSION, F.timestamp_millis("start_ms").alias("ts"), "online_status")
    )


def pair_by_join(records: DataFrame) -> DataFrame:
    """Pairs as connects joined to closes. Each side is one row per session before the join."""
    ms = timekeys.millis_of(F.col("ts"))

    def side(status: int, name: str, pick) -> DataFrame:
        return records.where(F.col("online_status") == status).groupBy(*SESSION).agg(pick(ms).alias(name))

    joined = side(1, "connected", F.min).join(side(0, "closed", F.max), SESSION)
    return joined.select(
        *SESSION, F.least("connected", "closed").alias("open_ms"), F.greatest("connected", "closed").alias("close_ms")
    )


def requeue_lines(records: DataFrame) -> DataFrame:
    """Unpaired records as raw log lines, ready to be published again."""
    return format_log_lines(unpaired_sessions(records), F.lit(REQUEUE_SERVER_IP))


# ---- connected seconds -------------------------------------------------------------------


def seconds_by_bucket(sessions: DataFrame, start: Column, end: Column, last: Column | None = None) -> DataFrame:
    """Connected seconds per terminal and bucket; whole seconds of each session in each bucket.

    ``last`` is the start of the last bucket; it defaults to the bucket ``end`` lies in. A session
    gives at most three rows however long it is: its seconds in the first and last bucket, and +1
    and -1 where the buckets between them begin and end. Those are summed per terminal and bucket
    before they move. A running sum over the sums of a terminal says how many sessions fill a bucket: it
    has at most a row per bucket that exists, however many records a busy terminal sends.
    """
    step = F.lit(BUCKET_MILLIS).cast("bigint")
    zero = F.lit(0).cast("bigint")
    first = timekeys.bucket_start_ms(F.col("start"))

    def change(bucket: Column, seconds: Column, filling: Column, touched: int) -> Column:
        return F.struct(
            bucket.alias("bucket"), seconds.alias("seconds"), filling.alias("filling"), F.lit(touched).cast("bigint").alias("touched")
        )

    one_bucket = F.array(change(F.col("first"), whole_div(F.col("end") - F.col("start"), 1000), zero, 1))
    several = F.array(
        change(F.col("first"), whole_div(F.col("first") + step - F.col("start"), 1000), zero, 1),
        change(F.col("first") + step, zero, zero + 1, 0),
        change(F.col("last"), whole_div(F.col("end") - F.col("last"), 1000), zero - 1, 1),
    )
    spans = sessions.select(
        "terminal_id", start.alias("start"), end.alias("end"), (timekeys.bucket_start_ms(end) if last is None else last).alias("last")
    ).withColumn("first", first)
    changes = (
        spans.select("terminal_id", F.explode(F.when(F.col("first") == F.col("last"), one_bucket).otherwise(several)).alias("c"))
        .select("terminal_id", "c.*")
        .groupBy("terminal_id", "bucket")
        .agg(F.sum("seconds").alias("seconds"), F.sum("filling").alias("filling"), F.sum("touched").alias("touched"))
    )
    in_order = Window.partitionBy("terminal_id").orderBy("bucket")
    filled = changes.withColumn("full", F.sum("filling").over(in_order)).withColumn(
        "until", F.coalesce(F.lead("bucket").over(in_order), F.col("bucket") + step)
    )
    filled = filled.where((F.col("touched") > 0) | (F.col("full") > 0))
    each = F.sequence("bucket", F.when(F.col("full") > 0, F.col("until") - step).otherwise(F.col("bucket")), step)
    own = F.when(F.col("at") == F.col("bucket"), F.col("seconds")).otherwise(0)
    return filled.select("terminal_id", "bucket", "seconds", "full", F.explode(each).alias("at")).select(
        "terminal_id",
        timekeys.time_id_of_millis(F.col("at")).alias("time_id"),
        (own + F.col("full") * BUCKET_SECONDS).cast("bigint").alias("duration_seconds"),
    )


def _same_bucket() -> Column:
    return timekeys.bucket_start_ms(F.col("start_ms")) == timekeys.bucket_start_ms(F.col("end_ms"))


def duration_same_bucket(records: DataFrame) -> DataFrame:
    pairs = pair_sessions(records).where(_same_bucket())
    return seconds_by_bucket(pairs, F.col("start_ms"), F.col("end_ms"))


def duration_cross_bucket(records: DataFrame) -> DataFrame:
    pairs = pair_sessions(records).where(~_same_bucket())
    return seconds_by_bucket(pairs, F.col("start_ms"), F.col("end_ms"))


def _as_of_bucket(as_of: datetime) -> Column:
    return timekeys.bucket_start_ms(F.unix_millis(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")))


def _accruing(accrue_lone_close: bool) -> Column:
    """Only an open connection goes on accruing, unless lone closes are asked for too."""
    return F.lit(True) if accrue_lone_close else F.col("online_status") == 1


def duration_open(records: DataFrame, as_of: datetime, accrue_lone_close: bool = False) -> DataFrame:
    """Sessions without a close (or connect) accrue up to the end of the bucket ``as_of`` lies in."""
    return seconds_of_sessions(session_bounds(records).where("not is_closed"), as_of, accrue_lone_close)


def duration_total(records: DataFrame, as_of: datetime, accrue_lone_close: bool = False) -> DataFrame:
    """Connected seconds of closed and still open sessions together."""
    return seconds_of_sessions(session_bounds(records), as_of, accrue_lone_close)


def seconds_of_sessions(sessions: DataFrame, as_of: datetime, accrue_lone_close: bool = False) -> DataFrame:
    """Connected seconds of reduced sessions, see :func:`bounds_of`.

    Same bucket, several buckets and still open differ only in where the session ends.
    """
    last = _as_of_bucket(as_of)
    is_open = ~F.col("is_closed")
    counted = sessions.where(
        ~is_open | (_accruing(accrue_lone_close) & (F.col("start_ms") < last + BUCKET_MILLIS))
    )
    end = F.when(is_open, last + BUCKET_MILLIS).otherwise(F.col("end_ms"))
    last_bucket = F.when(is_open, last).otherwise(timekeys.bucket_start_ms(F.col("end_ms")))
    return seconds_by_bucket(counted, F.col("start_ms"), end, last_bucket)


def metrics_long(records: DataFrame, as_of: datetime) -> DataFrame:
    """Connects, closes and connected seconds as ``metric``, ``value`` rows."""
    names = {"connect_num": LOG_CONNECT_NUM, "close_num": LOG_CLOSE_NUM}
    counted = status_counts(records).select(
        *KEYS, *[F.nullif(F.col(c), F.lit(0)).cast("double").alias(m) for c, m in names.items()]
    )
    counted = counted.unpivot(KEYS, list(names.values()), "metric", "value").where(F.col("value").isNotNull())
    seconds = duration_total(records, as_of).select(
        *KEYS, F.lit(LOG_CONNECTION_DURATION).alias("metric"), F.col("duration_seconds").cast("double").alias("value")
    )
    return counted.unionByName(seconds)


def bucket_series(intervals: DataFrame, start: Column, end: Column, ids: list[str]) -> DataFrame:
    """Every ten-minute key between two instants, ends included, in whichever order they come."""
    low = timekeys.bucket_start_ms(F.least(start, end))
    high = timekeys.bucket_start_ms(F.greatest(start, end))
    buckets = F.explode(F.sequence(low, high, F.lit(BUCKET_MILLIS).cast("bigint"))).alias("bucket")
    return intervals.select(*ids, buckets).select(*ids, timekeys.time_id_of_millis(F.col("bucket")).alias("time_id"))
