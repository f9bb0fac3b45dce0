"""Raw message lines: where they come from and how they become typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.functions import text, timekeys
from telemetra.schemas import (
    DEVICE_MILLIS_END,
    ENVELOPE,
    ENVELOPE_SEPARATOR,
    FIELD_SEPARATOR,
    GPS_COMMAND,
    POINT_SEPARATOR,
)


# ---- streams of lines --------------------------------------------------------------------


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """``topic``, binary ``value`` of one or several topics. Needs the Kafka connector package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return reader.load().select("topic", "value")


def publish_lines(lines: DataFrame, servers: str, topic: str) -> None:
    """Send the column ``value`` to a topic, in parallel from the executors."""
    (
        lines.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def text_file_stream(spark: SparkSession, path: str) -> DataFrame:
    """A folder of line files as a stream with the column ``value``."""
    return spark.readStream.text(path)


def clean_lines(lines: DataFrame) -> DataFrame:
    """Message text without the quotes some producers wrap it in."""
    return lines.select(text.strip_quotes(F.col("value").cast("string")).alias("value"))


# ---- GPS messages ------------------------------------------------------------------------


def is_gps_line(value: Column) -> Column:
    """Text test on the raw line, so other commands are dropped before any JSON is read."""
    return F.contains(value, F.lit(f'"cmdId":"{GPS_COMMAND}"'))


def filter_gps_lines(lines: DataFrame) -> DataFrame:
    return lines.where(is_gps_line(F.col("value")))


def _envelopes(lines: DataFrame) -> DataFrame:
    value = F.col("value")
    body = F.substr(value, F.instr(value, ENVELOPE_SEPARATOR) + len(ENVELOPE_SEPARATOR))
    return filter_gps_lines(lines).select("value", F.from_json(body, ENVELOPE).alias("envelope"))


def _typed_point(fields: Column, terminal_id: Column) -> Column:
    """Fields 0, 3, 6 and 9 of a point: time, speed, satellite count, online flag."""

    def field(i: int) -> Column:
        return F.trim(F.get(fields, F.lit(i)))

    return F.struct(
        terminal_id.alias("terminal_id"),
        field(0).alias("raw_time"),
        timekeys.parse_point_time(F.get(fields, F.lit(0))).alias("ts"),
        field(3).try_cast("double").alias("speed"),
        field(6).try_cast("int").alias("satellite_num"),
        field(9).try_cast("int").alias("online_status"),
        fields.alias("fields"),
    )


def _points(lines: DataFrame, first_only: bool = False) -> DataFrame:
    """Raw line and its points as typed structs; trailing empty points do not count.

    Points are typed inside the array, before it is exploded: a filter on a parsed field then
    stays above the explode and no line is decoded a second time to evaluate it.
    """
    message, terminal_id = F.col("envelope.message"), F.col("envelope.terminalId")
    payload = F.try_to_binary(message, F.lit("base64")).cast("string")
    texts = F.split(F.rtrim(payload, F.lit(POINT_SEPARATOR)), POINT_SEPARATOR)
    if first_only:
        texts = F.slice(texts, 1, 1)
    fields = F.transform(texts, lambda point: F.split(point, FIELD_SEPARATOR))
    typed = F.transform(fields, lambda f: _typed_point(f, terminal_id))
    return _envelopes(lines).select("value", F.explode_outer(typed).alias("p"))


def _is_whole() -> Column:
    whole = F.col("p").isNotNull()
    for name in ("terminal_id", "ts", "speed", "satellite_num", "online_status"):
        whole = whole & F.col(f"p.{name}").isNotNull()
    return whole & is_device_time(F.col("p.ts"))


POINT_COLUMNS = ["terminal_id", "raw_time", "ts", "speed", "satellite_num", "online_status"]


def _whole_points(lines: DataFrame, first_only: bool) -> DataFrame:
    return _points(lines, first_only).where(_is_whole()).select(*[f"p.{name}" for name in POINT_COLUMNS])


def parse_gps_lines(lines: DataFrame) -> DataFrame:
    """One row per point of every GPS message; lines or points that do not parse are left out
    here and come back from :func:`gps_rejects`."""
    return _whole_points(lines, first_only=False)


def parse_gps_first_points(lines: DataFrame) -> DataFrame:
    """Only the first point of each message."""
    return _whole_points(lines, first_only=True)


def gps_rejects(lines: DataFrame) -> DataFrame:
    """GPS lines or single points that could not be read, with the point text if there is one."""
    return _points(lines).where(~_is_whole()).select("value", F.array_join("p.fields", FIELD_SEPARATOR).alias("point"))


# ---- connection log ----------------------------------------------------------------------


_NAMED_TEXT = "[^,:]*:[^,:]+(?::[^,]*)?"
_NAMED_MILLIS = "[^,:]*: *[0-9]{1,13} *(?::[^,]*)?"
_NAMED_STATUS = "[^,:]*: *[0-9]{1,9} *(?::[^,]*)?"
LOG_LINE = rf"\A{_NAMED_TEXT},{_NAMED_TEXT},{_NAMED_MILLIS},{_NAMED_STATUS},[^,]+,*\z"


def is_device_time(ts: Column) -> Column:
    """Device times reach from 1970 to before 2100; anything else is a fault of the device."""
    return (ts >= F.timestamp_millis(F.lit(0))) & (ts < F.timestamp_millis(F.lit(DEVICE_MILLIS_END)))


def _log_field(value: Column, i: int) -> Column:
    return F.split_part(F.get(F.split(value, FIELD_SEPARATOR), F.lit(i)), F.lit(":"), F.lit(2))


def is_log_line(value: Column) -> Column:
    """Whether a line has the five fields and a time a device can report."""
    ts = F.timestamp_millis(F.trim(_log_field(value, 2)).try_cast("bigint"))
    return value.rlike(LOG_LINE) & F.coalesce(is_device_time(ts), F.lit(False))


def log_rejects(lines: DataFrame) -> DataFrame:
    """Lines that are neither GPS messages nor readable log records."""
    value = F.col("value")
    return lines.where(~is_log_line(value) & ~F.contains(value, F.lit(ENVELOPE_SEPARATOR)))


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """``serialNum:..,terminalId:..,time:<ms>,online:..,serverIp:..`` to typed records.

    A line counts only with exactly five comma fields, trailing empty ones ignored. The whole
    line is tested once, as text; after that every field is known to be there.
    """

    def value(i: int) -> Column:
        return _log_field(F.col("value"), i)

    return lines.where(is_log_line(F.col("value"))).select(
        value(0).alias("serial_num"),
        value(1).alias("terminal_id"),
        F.timestamp_millis(value(2).cast("bigint")).alias("ts"),
        value(3).cast("int").alias("online_status"),
    )


def format_log_lines(records: DataFrame, server_ip: Column) -> DataFrame:
    """Typed records back to raw log lines."""
    return records.select(
        F.concat(
            F.lit("serialNum:"), F.col("serial_num"),
            F.lit(",terminalId:"), F.col("terminal_id"),
            F.lit(",time:"), timekeys.millis_of(F.col("ts")).cast("string"),
            F.lit(",online:"), F.col("online_status").cast("string"),
            F.lit(",serverIp:"), server_ip,
        ).alias("value")
    )
