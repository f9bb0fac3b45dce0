"""Rows a stream with a watermark does not count any more, kept as a list of buckets to count again.

A second query on the same source tells them from the newest event time it has seen, its own batch
included. That is never behind what the counting query had seen when it met the same row, so every row
dropped there is found here; a bucket that is named too early is only counted once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetra.functions import timekeys
from telemetra.ordering import Folder
from telemetra.schemas import BUCKET_MILLIS
from telemetra.streaming import parts
from telemetra.streaming.sinks import AVAILABLE_NOW, for_each_batch

DELAY_MILLIS = 600_000


def gather_late(
    points: DataFrame, path: str, checkpoint: str, delay_millis: int = DELAY_MILLIS, trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """``(terminal_id, time_id)`` of buckets with points below the watermark, a folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = parts.run_number(spark, path, checkpoint)
        marks = Folder(spark, f"{path}/marks")
        known = marks.names()
        before = f"{run}-{batch_id - 1}"
        points = batch.persist()
        try:
            seen = [points.agg(F.max(F.unix_millis("ts"))).first()[0]]
            seen += [int(marks.text(before))] if before in known else []
            newest = max((x for x in seen if x is not None), default=0)
            end = timekeys.bucket_start_ms(F.unix_millis("ts")) + BUCKET_MILLIS
            late = points.where(end <= newest - delay_millis)
            late = late.select("terminal_id", timekeys.time_id(F.col("ts")).alias("time_id")).distinct()
            parts.write_part(late, path, run, batch_id)
        finally:
            points.unpersist()
        # A batch that runs again sees what it saw before, and finds its mark.
        if f"{run}-{batch_id}" not in known:
            marks.create(f"{run}-{batch_id}", str(newest))
        for name in known:
            number, batch_of = map(int, name.split("-"))
            if number == run and batch_of < batch_id - 1:
                marks.remove(name)

    return for_each_batch(points, write, checkpoint, "append", trigger)


def waiting(spark: SparkSession, path: str) -> tuple[list[str], DataFrame | None]:
    """The complete batches no correction has dealt with yet, and their buckets."""
    done = Folder(spark, f"{path}/corrected").names()
    found = [name.rpartition("/")[0] for name in Folder(spark, f"{path}/parts").matching("run=*/batch=*/_SUCCESS")]
    batches = [name for name in found if name.replace("/", ",") not in done]
    if not batches:
        return [], None
    buckets = spark.read.schema("terminal_id string, time_id string").parquet(*[f"{path}/parts/{name}" for name in batches])
    return batches, buckets.distinct()


def done(spark: SparkSession, path: str, batches: list[str]) -> None:
    """Batches whose buckets have been counted again."""
    corrected = Folder(spark, f"{path}/corrected")
    for name in batches:
        corrected.create(name.replace("/", ","))
