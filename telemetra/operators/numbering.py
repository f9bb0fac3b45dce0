"""Consecutive numbers over a whole frame without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.workspace import shared_dir

_PARTITION_SHIFT = 33


def with_row_number(
    df: DataFrame,
    order: list[Column],
    name: str = "row_number",
    partitions: int | None = None,
    may_tie: bool = False,
) -> DataFrame:
    """Number rows 1..n in the given order.

    Rows are range-partitioned and sorted in parallel and numbered within their partition. With
    ``may_tie`` the order of arrival joins the sort key, which spreads even a mass of equal rows;
    it needs an input whose rows arrive in the same order when a task is repeated, such as a file
    scan. Without it ``order`` has to tell all rows apart. The only gathered data is one count per partition, from which each partition learns its offset.
    The numbered rows are checkpointed, because both the counts and the rows must see the same
    partitioning even if an executor is lost in between.
    """
    shared_dir(df.sparkSession)
    if may_tie:
        df = df.withColumn("_arrival", F.monotonically_increasing_id())
        order = [*order, F.col("_arrival")]
    # Without a given number, adaptive execution merges small neighbouring ranges.
    ranges = [partitions, *order] if partitions else order
    ranged = (
        df.repartitionByRange(*ranges)
        .sortWithinPartitions(*order)
        .drop("_arrival")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _PARTITION_SHIFT))
        .withColumn("_nth", F.col("_id") - F.shiftleft("_part", _PARTITION_SHIFT) + 1)
        .drop("_id")
        .checkpoint()
    )
    before = F.coalesce(
        F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # One row per range partition, so the ordered window and the broadcast stay small whatever
    # the size of the data.
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select("_part", before.alias("_before"))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_nth"))
        .drop("_part", "_nth", "_before")
    )
