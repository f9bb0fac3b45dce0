"""Hour and day roll-ups of long metric rows ``(terminal_id, time_id, metric, value)``.

Keys nest as text prefixes, so any finer period can feed a coarser one. Child keys are compared
as numbers: with fixed-width buffers every roll-up stays a hash aggregation.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from telemetra.functions import timekeys
from telemetra.operators.point_metrics import online_percent
from telemetra.schemas import DAY_KEY, GPS_FREQUENT, GPS_ONLINE_PERCENT, GPS_ONLINE_TOTAL, GPS_TOTAL_NUM, HOUR_KEY, METRIC

KEYS = ["terminal_id", "time_id"]


def _to_parent(metrics: DataFrame, key_length: int) -> DataFrame:
    return metrics.select(
        "terminal_id",
        timekeys.parent_key(F.col("time_id"), key_length).alias("parent_id"),
        F.col("time_id").cast("bigint").alias("child_id"),
        "metric",
        "value",
    )


def sum_metrics(metrics: DataFrame, key_length: int) -> DataFrame:
    """Sum of every metric that adds up; percent and frequency do not."""
    additive = metrics.where(~F.col("metric").isin(GPS_ONLINE_PERCENT, GPS_FREQUENT))
    return (
        _to_parent(additive, key_length)
        .groupBy("terminal_id", F.col("parent_id").alias("time_id"), "metric")
        .agg(F.sum("value").alias("value"))
    )


def latest_frequency(metrics: DataFrame, key_length: int) -> DataFrame:
    """Frequency is not aggregated: the period shows the value of its latest child bucket."""
    return (
        _to_parent(metrics.where(F.col("metric") == GPS_FREQUENT), key_length)
        .groupBy("terminal_id", F.col("parent_id").alias("time_id"), "metric")
        .agg(F.max_by("value", "child_id").alias("value"))
    )


def percent_of_sums(metrics: DataFrame, key_length: int) -> DataFrame:
    """Online share recomputed from the summed total and online counts of the period."""

    def summed(metric: str) -> Column:
        return F.sum(F.when(F.col("metric") == metric, F.col("value"))).cast("bigint")

    return (
        _to_parent(metrics.where(F.col("metric").isin(GPS_TOTAL_NUM, GPS_ONLINE_TOTAL)), key_length)
        .groupBy("terminal_id", F.col("parent_id").alias("time_id"))
        .agg(summed(GPS_TOTAL_NUM).alias("total"), summed(GPS_ONLINE_TOTAL).alias("online"))
        .select(
            *KEYS,
            F.lit(GPS_ONLINE_PERCENT).alias("metric"),
            online_percent(F.col("total"), F.col("online")).alias("value"),
        )
        .where(F.col("value").isNotNull())
    )


def rollup(metrics: DataFrame, key_length: int) -> DataFrame:
    """Frequency, percent and sums of the period in one frame.

    One aggregation by terminal, period and metric gives the sum and the latest child's value. The
    percent comes from its rows for total and online counts, as one more row beside the total.
    """
    period = ["terminal_id", "parent_id"]
    name = F.col("metric")
    summed = (
        _to_parent(metrics.where(name != GPS_ONLINE_PERCENT), key_length)
        .groupBy(*period, "metric")
        .agg(F.sum("value").alias("total"), F.max_by("value", "child_id").alias("latest"))
    )

    def of_period(metric: str) -> Column:
        whole = F.sum(F.when(name == metric, F.col("total"))).over(Window.partitionBy(*period))
        return whole.cast("bigint")

    share = online_percent(of_period(GPS_TOTAL_NUM), of_period(GPS_ONLINE_TOTAL))
    own = F.when(name == GPS_FREQUENT, F.col("latest")).otherwise(F.col("total"))
    line = F.struct(name.alias("metric"), F.col("value"))
    percent = F.struct(F.lit(GPS_ONLINE_PERCENT).alias("metric"), F.col("share").alias("value"))
    with_percent = (name == GPS_TOTAL_NUM) & F.col("share").isNotNull()
    return (
        summed.select(*period, "metric", own.alias("value"), share.alias("share"))
        .select(
            "terminal_id",
            F.col("parent_id").alias("time_id"),
            F.explode(F.when(with_percent, F.array(line, percent)).otherwise(F.array(line))).alias("row"),
        )
        .select(*KEYS, "row.metric", "row.value")
    )


def previous_period(as_of: datetime, key_length: int) -> str:
    """Key of the hour (10) or day (8) before ``as_of``."""
    if key_length == HOUR_KEY:
        return (as_of - timedelta(hours=1)).strftime("%Y%m%d%H")
    if key_length == DAY_KEY:
        return (as_of - timedelta(hours=24)).strftime("%Y%m%d")
    raise ValueError(f"no period has a key of length {key_length}")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Store long metric rows by day, sorted by metric and time so that scans can skip."""
    by_day = metrics.withColumn("day", timekeys.parent_key(F.col("time_id"), DAY_KEY))
    balanced = by_day.hint("rebalance", "day").sortWithinPartitions("day", "metric", "time_id")
    balanced.write.mode("append").partitionBy("day").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC).parquet(path)


def only_period(metrics: DataFrame, period: str) -> DataFrame:
    """Rows of a stored metric table in an hour or day: one folder, then a prefix test."""
    in_day = F.col("day") == period[:DAY_KEY]
    return metrics.where(in_day & F.col("time_id").startswith(period))


def with_period(cells: DataFrame, key_length: int) -> DataFrame:
    """Cells with the terminal and the parent period of their key beside them."""
    key, time_id = F.col("row_key"), F.substring_index("row_key", "_", -1)
    terminal = F.substring(key, F.lit(1), F.length(key) - F.length(time_id) - 1)
    return cells.withColumns({"terminal_id": terminal, "parent_id": timekeys.parent_key(time_id, key_length)})


def explode_cells(cells: DataFrame, key_length: int) -> DataFrame:
    """One row per stored cell of a metric table, keyed by terminal and parent period."""
    key, time_id = F.col("row_key"), F.substring_index("row_key", "_", -1)
    return cells.select(
        F.substring(key, F.lit(1), F.length(key) - F.length(time_id) - 1).alias("terminal_id"),
        timekeys.parent_key(time_id, key_length).alias("parent_id"),
        F.col("qualifier").alias("metric"),
        "value",
    )
