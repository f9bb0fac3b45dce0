"""GPS quality metrics per terminal and ten-minute bucket.

All nine metrics come from one conditional aggregation: one scan, one shuffle with map-side
partial counts. Grouping is on the bucket start as a long; the key text is formatted once per
result row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.functions import timekeys
from telemetra.functions.numbers import ratio_half_up, whole_div
from telemetra.schemas import GPS_FREQUENT, GPS_METRIC_COLUMNS, GPS_ONLINE_PERCENT, GPS_TOTAL_NUM

# Points of a full bucket, and the divisor from points to sampling frequency.
POINTS_PER_BUCKET = 15
FREQUENCY_DIVISOR = 15

KEYS = ["terminal_id", "time_id"]


def point_rules() -> dict[str, Column]:
    """Which points each counting metric counts."""
    satellites, online = F.col("satellite_num"), F.col("online_status")
    return {
        "gps_online_total": online == 1,
        "gps_offline_total": online == 0,
        "gps_weak_num": (satellites > 0) & (satellites < 4),
        "gps_not_open_num": satellites == -1,
        "gps_zero_speed_num": F.col("speed") == 0,
        "gps_normal_num": (online == 1) & (satellites >= 4),
    }


def _with_bucket(points: DataFrame) -> DataFrame:
    return points.withColumn("bucket", timekeys.bucket_seconds(F.col("ts")))


def _with_time_id(df: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in (*keys, "bucket")]
    return df.select(*keys, timekeys.time_id_of_seconds(F.col("bucket")).alias("time_id"), *rest)


def corrected_total(count: Column, points_per_bucket: int) -> Column:
    """A bucket is either full (N points) or sampled at a fifth of that."""
    fifth = points_per_bucket // 5
    return F.when(count > fifth, points_per_bucket).otherwise(fifth).cast("bigint")


def frequency(total: Column) -> Column:
    return whole_div(total, FREQUENCY_DIVISOR)


def online_percent(total: Column, online: Column) -> Column:
    """Null when no point was online."""
    return F.when(online > 0, ratio_half_up(total, online))


def counts(points: DataFrame, extra_keys: list[str] = (), extra: list[Column] = ()) -> DataFrame:
    """Plain counts per key: ``n`` points and one column per rule."""
    keys = ["terminal_id", *extra_keys]
    counted = _with_bucket(points).groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(rule).alias(name) for name, rule in point_rules().items()],
        *extra,
    )
    return _with_time_id(counted, keys)


def derive_metrics(counted: DataFrame, points_per_bucket: int = POINTS_PER_BUCKET) -> DataFrame:
    """Total, frequency and online share from plain counts; columns in metric order."""
    total = F.col("gps_total_num")
    derived = (
        counted.withColumn("gps_total_num", corrected_total(F.col("n"), points_per_bucket))
        .withColumn("gps_frequent", frequency(total))
        .withColumn("gps_online_percent", online_percent(total, F.col("gps_online_total")))
        .drop("n")
    )
    others = [c for c in derived.columns if c not in GPS_METRIC_COLUMNS]
    return derived.select(*others, *GPS_METRIC_COLUMNS)


def metrics_wide(points: DataFrame, points_per_bucket: int = POINTS_PER_BUCKET) -> DataFrame:
    """All nine metrics in one row per terminal and bucket."""
    return derive_metrics(counts(points), points_per_bucket)


def count_metric(points: DataFrame, name: str) -> DataFrame:
    """One counting metric; a key without a matching point has no row."""
    matched = _with_bucket(points.where(point_rules()[name]))
    counted = matched.groupBy("terminal_id", "bucket").agg(F.count(F.lit(1)).alias(name))
    return _with_time_id(counted, ["terminal_id"])


def total_metric(points: DataFrame, points_per_bucket: int = POINTS_PER_BUCKET) -> DataFrame:
    counted = _with_bucket(points).groupBy("terminal_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    total = corrected_total(F.col("n"), points_per_bucket)
    return _with_time_id(counted, ["terminal_id"]).select(*KEYS, total.alias("gps_total_num"))


def frequent_metric(points: DataFrame, points_per_bucket: int = POINTS_PER_BUCKET) -> DataFrame:
    totals = total_metric(points, points_per_bucket)
    return totals.select(*KEYS, frequency(F.col("gps_total_num")).alias("gps_frequent"))


def percent_metric(points: DataFrame, points_per_bucket: int = POINTS_PER_BUCKET) -> DataFrame:
    wide = metrics_wide(points, points_per_bucket)
    return wide.where(F.col("gps_online_percent").isNotNull()).select(*KEYS, "gps_online_percent")


def percent_by_join(totals: DataFrame, onlines: DataFrame) -> DataFrame:
    """Online share from two metric frames joined on their key."""
    percent = online_percent(F.col("gps_total_num"), F.col("gps_online_total"))
    return totals.join(onlines, KEYS).select(*KEYS, percent.alias("gps_online_percent"))


def left_joined(totals: DataFrame, frames: list[DataFrame]) -> DataFrame:
    """Metric frames of different origin side by side, by terminal and bucket key; an absent metric is null.

    Frames that come from the same points need no join, see :func:`wide_with_absent`.
    """
    return reduce(lambda left, right: left.join(right, KEYS, "left"), frames, totals)


def wide_with_absent(points: DataFrame, points_per_bucket: int = POINTS_PER_BUCKET) -> DataFrame:
    """The wide row as left joins of one frame per metric would give it: an absent metric is null.

    All frames would come from one aggregation with the same key, so each is a column of it and the
    joins fall away: one scan, one exchange of partial counts.
    """
    wide = metrics_wide(points, points_per_bucket)
    return wide.select(*KEYS, *[_absent_as_null(name, metric).alias(name) for name, metric in GPS_METRIC_COLUMNS.items()])


def _absent_as_null(name: str, metric: str) -> Column:
    """A count of zero means the metric has no row; totals, frequency and share stay as they are."""
    if metric in (GPS_TOTAL_NUM, GPS_FREQUENT, GPS_ONLINE_PERCENT):
        return F.col(name)
    return F.when(F.col(name) > 0, F.col(name))


def wide_to_long(wide: DataFrame, names: dict[str, str], ids: list[str], as_text: bool = False) -> DataFrame:
    """One row per present metric: ``ids``, ``metric``, ``value``."""
    kind = "string" if as_text else "double"
    values = [_absent_as_null(name, metric).cast(kind).alias(metric) for name, metric in names.items()]
    return (
        wide.select(*ids, *values)
        .unpivot(ids, list(names.values()), "metric", "value")
        .where(F.col("value").isNotNull())
    )


def metrics_long(points: DataFrame, points_per_bucket: int = POINTS_PER_BUCKET) -> DataFrame:
    return wide_to_long(metrics_wide(points, points_per_bucket), GPS_METRIC_COLUMNS, KEYS)
