"""Sinks whose result is a table in the shared folder, and how to run a stream into them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from telemetra.streaming import parts


def parquet_stream(spark: SparkSession, schema: StructType, path: str, max_files: int | None = None) -> DataFrame:
    """A folder that parquet files arrive in, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_available(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query; a failure in it is raised here."""
    query.awaitTermination()


# Take what has arrived and stop. A live job passes e.g. {"processingTime": "15 seconds"}.
AVAILABLE_NOW = {"availableNow": True}


def append_to_files(
    stream: DataFrame, path: str, checkpoint: str, file_format: str = "parquet", trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Finished rows go to files, each exactly once."""
    writer = stream.writeStream.format(file_format).outputMode("append").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def for_each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).outputMode(output_mode)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def upsert_to_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Changed rows of each micro-batch go to the folder of the run and the batch.

    A batch that runs again after a failure overwrites the same folder, so nothing counts twice. A new
    checkpoint is a run of its own, whose rows win over those of the runs before.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        parts.write_part(changes, path, parts.run_number(changes.sparkSession, path, checkpoint), batch_id)

    return for_each_batch(stream, write, checkpoint, trigger=trigger)


def _upserts(spark: SparkSession, path: str, keys: list[str]) -> tuple[StructType, parts.Merge]:
    """The columns of an upsert sink, and how rows of a key merge: the latest batch of the latest run wins."""
    kept = "merged" if parts.version_of(spark, path).number else "parts"
    columns = spark.read.parquet(f"{path}/{kept}").drop("run", "batch", "changed", "version", "place").schema
    values = [c for c in columns.names if c not in keys]

    def newest(rows: DataFrame, *beside: Column) -> DataFrame:
        last = F.max(F.struct("run", "batch", *values)).alias("newest")
        return rows.groupBy(*keys).agg(last, *beside).select("*", *[f"newest.{c}" for c in values]).drop("newest")

    return columns, newest


def read_upserts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current rows of an upsert sink."""
    columns, newest = _upserts(spark, path, keys)
    return parts.read_parts(spark, path, columns, newest).select(*keys, *[c for c in columns.names if c not in keys])


def compact_upserts(spark: SparkSession, path: str, keys: list[str], everything: bool = False) -> None:
    """Merge the batches of an upsert sink, see :mod:`telemetra.streaming.parts`."""
    parts.compact(spark, path, *_upserts(spark, path, keys), everything=everything)


def preview(stream: DataFrame, order: list[str], path: str, checkpoint: str, rows: int = 10) -> StreamingQuery:
    """The first rows of every micro-batch in a stated order, as one would print them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.orderBy(*order).limit(rows).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return for_each_batch(stream, write, checkpoint, "append")
