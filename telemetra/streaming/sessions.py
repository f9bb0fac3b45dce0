"""Live session pairing: every micro-batch adds what it knows of its sessions, reads merge it.

The state of a session (first connect, last close) can be merged in any order, so a batch is reduced
by itself and written to a folder of its own. Nothing is held in memory between batches, no record
is too late, and copies change nothing: what is read is what a batch job finds over all records.
:func:`compact_sessions` merges the folders from time to time; it writes the sessions that changed of
late, and those that have settled are not written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from telemetra import schemas
from telemetra.operators.sessions import bounds_of, merged_states, session_state
from telemetra.streaming import parts
from telemetra.streaming.sinks import AVAILABLE_NOW, for_each_batch


def gather_sessions(records: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """One row per session of each micro-batch. A batch that runs again overwrites its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        parts.write_part(session_state(batch), path, parts.run_number(batch.sparkSession, path, checkpoint), batch_id)

    return for_each_batch(records, write, checkpoint, "append", trigger)


def session_states(spark: SparkSession, path: str) -> DataFrame:
    """The state of every session so far."""
    return parts.read_parts(spark, path, schemas.SESSION_STATE, merged_states)


def compact_sessions(
    spark: SparkSession, path: str, settles_after: int = parts.SETTLES_AFTER, everything: bool = False
) -> None:
    """Merge the batches so far, see :mod:`telemetra.streaming.parts`; ``everything`` includes settled sessions."""
    parts.compact(spark, path, schemas.SESSION_STATE, merged_states, settles_after, everything)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Sessions with both ends known."""
    return bounds_of(session_states(spark, path)).where("is_closed")


def read_carry(spark: SparkSession, path: str) -> DataFrame:
    """Sessions still open."""
    return bounds_of(session_states(spark, path)).where("not is_closed")
