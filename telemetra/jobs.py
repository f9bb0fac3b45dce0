"""The jobs as they are run: live metrics into the store, and period roll-ups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetra.functions import timekeys
from telemetra.operators import cells, rollup
from telemetra.operators import sessions as session_ops
from telemetra.operators.point_metrics import metrics_wide
from telemetra.ordering import Folder
from telemetra.schemas import (
    GPS_METRIC_COLUMNS,
    LOG_CLOSE_NUM,
    LOG_CONNECT_NUM,
    LOG_CONNECTION_DURATION,
    TEN_MINUTE_KEY,
)
from telemetra.sources import lines as src
from telemetra.streaming import late, metrics, sessions
from telemetra.streaming.sinks import AVAILABLE_NOW, append_to_files, for_each_batch
from telemetra.workspace import new_dir

LOG_COUNT_COLUMNS = {"connect_num": LOG_CONNECT_NUM, "close_num": LOG_CLOSE_NUM}


def _put(metrics: DataFrame, names: dict[str, str], path: str) -> None:
    """Wide metric rows as the next write of a cell table."""
    cells.put_cells(cells.metric_text_cells(metrics, names, F.lit(0).cast("bigint")), path)


def live_cells(
    stream: DataFrame, names: dict[str, str], path: str, checkpoint: str, trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Changed buckets of each micro-batch become cells.

    Each batch is the next write of the table, after corrections and deletes that came before it. A
    repeated batch writes the same values again.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        _put(changes, names, path)

    return for_each_batch(stream, write, checkpoint, trigger=trigger)


def live_rejects(lines: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Lines and points of a stream that cannot be read, into the table at ``path``.

    ``kind`` says what was tried: a GPS line (with the point text, if one point is at fault) or a log line.
    """
    clean = src.clean_lines(lines)
    gps = src.gps_rejects(clean).select(F.lit("gps").alias("kind"), "value", "point")
    log = src.log_rejects(clean).select(F.lit("log").alias("kind"), "value", F.lit(None).cast("string").alias("point"))
    return append_to_files(gps.unionByName(log), path, checkpoint, trigger=trigger)


def live_gps_metrics(
    lines: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes", trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Raw lines of a stream to GPS metric cells in the table at ``path``."""
    points = src.parse_gps_lines(src.clean_lines(lines)).drop("raw_time")
    return live_cells(metrics.gps_metrics(points, delay), GPS_METRIC_COLUMNS, path, checkpoint, trigger)


def live_log_counts(
    lines: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes", trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Raw lines of a stream to connect and close cells."""
    records = src.parse_log_lines(src.clean_lines(lines))
    return live_cells(metrics.log_counts(records, delay), LOG_COUNT_COLUMNS, path, checkpoint, trigger)


def correct_gps_metrics(lines: DataFrame, path: str) -> None:
    """Recompute the buckets of kept raw lines and write them over what the stream has written.

    The watermark drops points that come too late; this batch job counts them. ``lines`` has all
    lines of the buckets in question, a day's folder for instance.
    """
    points = src.parse_gps_lines(src.clean_lines(lines)).drop("raw_time")
    _put(metrics_wide(points), GPS_METRIC_COLUMNS, path)


def correct_log_counts(lines: DataFrame, path: str) -> None:
    """The same for connects and closes."""
    counted = session_ops.status_counts(src.parse_log_lines(src.clean_lines(lines)))
    _put(counted, LOG_COUNT_COLUMNS, path)


def correct_late_points(points: DataFrame, late_path: str, table: str) -> int:
    """Count the buckets again that :func:`telemetra.streaming.late.gather_late` has found late points for.

    ``points`` are all kept points, or those of the days in question. Buckets are counted from scratch, so
    one that was named without need gets the value it has. Returns the number of batches that were done.
    """
    spark = points.sparkSession
    batches, buckets = late.waiting(spark, late_path)
    if batches:
        at = points.withColumn("time_id", timekeys.time_id(F.col("ts")))
        again = at.join(buckets, ["terminal_id", "time_id"], "left_semi").drop("time_id")
        _put(metrics_wide(again), GPS_METRIC_COLUMNS, table)
        late.done(spark, late_path, batches)
    return len(batches)


def live_sessions(lines: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Raw lines of a stream to session states, closed and open ones."""
    return sessions.gather_sessions(src.parse_log_lines(src.clean_lines(lines)), path, checkpoint, trigger)


def connected_seconds(spark: SparkSession, path: str, as_of: datetime) -> DataFrame:
    """Connected seconds from what :func:`live_sessions` has written so far."""
    return session_ops.seconds_of_sessions(session_ops.bounds_of(sessions.session_states(spark, path)), as_of)


def store_connected_seconds(
    spark: SparkSession, path: str, table: str, as_of: datetime, since: datetime | None = None
) -> None:
    """Connected seconds as cells in ``table``, the third log metric beside connects and closes.

    ``since`` leaves out the buckets before it. A later run writes over what this one wrote, so
    seconds of sessions that have closed meanwhile, or that arrived late, are put right.
    """
    seconds = connected_seconds(spark, path, as_of)
    if since is not None:
        seconds = seconds.where(F.col("time_id") >= since.strftime("%Y%m%d%H%M")[:TEN_MINUTE_KEY])
    _put(seconds, {"duration_seconds": LOG_CONNECTION_DURATION}, table)


def metrics_of_cells(stored: DataFrame) -> DataFrame:
    """Current cells of a metric table as long metric rows. The time is what follows the last
    underscore of the key, so terminals may have underscores in their names."""
    key = F.col("row_key")
    time_id = F.substring_index(key, "_", -1)
    return stored.select(
        F.substring(key, F.lit(1), F.length(key) - F.length(time_id) - 1).alias("terminal_id"),
        time_id.alias("time_id"),
        F.col("qualifier").alias("metric"),
        F.col("value").cast("double").alias("value"),
        "day",
    )


def _as_cells(rolled: DataFrame) -> DataFrame:
    """Rolled-up metrics as cells; only the share is no whole number."""
    is_ratio = F.col("metric") == GPS_METRIC_COLUMNS["gps_online_percent"]
    whole = F.col("value").cast("bigint").cast("string")
    as_text = F.when(is_ratio, F.col("value").cast("string")).otherwise(whole)
    return cells.cells_of_metrics(rolled.withColumn("value", as_text), F.lit(0).cast("bigint"))


def roll_up_changes(spark: SparkSession, source: str, target: str, key_length: int, grace: float = 3600.0) -> int:
    """Roll up the hours (10) or days (8) that were written to since the last call; returns their number.

    The writes since then name the terminals and periods to do again: a late bucket, a correction or a
    delete costs its own periods only, and their files are found by the statistics of their write numbers.
    What a period no longer has is deleted in the target. The position is kept in the target, written
    last, so a call that fails is made up for by the next. A write that has not ended keeps later ones
    waiting for ``grace`` seconds at most.
    """
    place = Folder(spark, f"{target}/_rolled")
    since = max((int(name) for name in place.names()), default=0)
    upto = cells.newest_write(spark, source, grace)
    if upto <= since:
        return 0
    new = cells.read_cells(spark, source).where((F.col("write_ts") > since) & (F.col("write_ts") <= upto))
    new_dirty = rollup.with_period(new, key_length).select("day", "terminal_id", "parent_id").distinct()
    path = new_dir(spark, "dirty-periods")
    new_dirty.write.parquet(path)
    dirty = spark.read.schema(new_dirty.schema).parquet(path)
    written = rollup.with_period(cells.read_cells(spark, source), key_length)
    current = cells.current_cells(written.join(dirty, ["day", "terminal_id", "parent_id"], "left_semi").drop("terminal_id", "parent_id"))
    rolled = _as_cells(rollup.rollup(metrics_of_cells(current), key_length)).persist()
    try:
        own = dirty.select(cells.row_key(F.col("terminal_id"), F.col("parent_id")).alias("row_key"), "day")
        if Folder(spark, target).names().keys() - {"_rolled", "_orders"}:
            before = cells.current_cells(cells.read_cells(spark, target).join(own, ["day", "row_key"], "left_semi"))
            gone = before.join(rolled, ["row_key", "qualifier"], "left_anti").select("row_key").distinct()
            if not gone.isEmpty():
                cells.delete_stored_rows(gone, target)
        cells.put_cells(rolled, target)
    finally:
        rolled.unpersist()
    place.create(f"{upto:019d}")
    return dirty.count()


def roll_up_previous(spark: SparkSession, source: str, target: str, as_of: datetime, key_length: int) -> bool:
    """Roll the hour (10) or day (8) before ``as_of`` up from the cells at ``source`` into the
    cells at ``target``. Nothing is written for an empty period; returns whether there was any.
    A second run for the same period, after a correction, writes over the first."""
    period = rollup.previous_period(as_of, key_length)
    stored = metrics_of_cells(cells.stored_cells(spark, source))
    rolled = rollup.rollup(rollup.only_period(stored, period), key_length).persist()
    try:
        if rolled.isEmpty():
            return False
        cells.put_cells(_as_cells(rolled), target)
        return True
    finally:
        rolled.unpersist()
