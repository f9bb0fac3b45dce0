"""Hour and day roll-ups, and the union of GPS and log metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from telemetra import jobs
from telemetra.functions import timekeys
from telemetra.operators import cells, point_metrics, rollup, sessions
from telemetra.plans.cell_store import CELLS_SQL, cell_table
from telemetra.plans.inputs import AS_OF, GPS_LONG_SQL, gps_points, log_records
from telemetra.plans.registry import query
from telemetra.plans.sessions import LOG_LONG_SQL
from telemetra.plans.staging import staged
from telemetra.schemas import DAY_KEY, GPS_METRIC_COLUMNS, HOUR_KEY
from telemetra.workspace import new_dir

ALL_LONG_SQL = f"""{GPS_LONG_SQL}, {LOG_LONG_SQL},
cells AS (SELECT * FROM gps_long UNION ALL SELECT * FROM log_long)"""

# A moment inside the test month, so that the hour and the day before it hold data.
ROLLUP_AS_OF = datetime(2024, 1, 15, 13, 20, 0)


def all_metrics(spark, sf_dir):
    """GPS and log metrics of one store: bag union."""
    gps = point_metrics.metrics_long(gps_points(spark, sf_dir))
    return gps.unionByName(sessions.metrics_long(log_records(spark, sf_dir), AS_OF))


def metric_table(spark, sf_dir):
    """The ten-minute metrics as a stored table, which is what the roll-ups read."""
    path = staged(
        spark, sf_dir, "ten-minute-metrics", lambda p: rollup.write_metrics(all_metrics(spark, sf_dir), p)
    )
    return rollup.read_metrics(spark, path)


def _sums(length: int, source: str = "cells") -> str:
    return f"""SELECT terminal_id, substr(time_id, 1, {length}) AS time_id, metric, sum(value) AS value
FROM {source} WHERE metric NOT IN ('gpsOnlinePercent', 'gpsFrequent') GROUP BY ALL"""


def _frequency(length: int) -> str:
    return f"""SELECT terminal_id, substr(time_id, 1, {length}) AS time_id, metric, max_by(value, time_id) AS value
FROM cells WHERE metric = 'gpsFrequent' GROUP BY terminal_id, substr(time_id, 1, {length}), metric"""


def _percent(length: int) -> str:
    return f"""SELECT terminal_id, time_id, 'gpsOnlinePercent' AS metric,
       ((200 * least(total, onl) + greatest(total, onl)) // (2 * greatest(total, onl))) / 100.0::DOUBLE AS value
FROM (
  SELECT terminal_id, substr(time_id, 1, {length}) AS time_id,
         CAST(sum(value) FILTER (WHERE metric = 'gpsTotalNum') AS BIGINT) AS total,
         CAST(sum(value) FILTER (WHERE metric = 'gpsOnlineTotal') AS BIGINT) AS onl
  FROM cells GROUP BY terminal_id, substr(time_id, 1, {length})
) WHERE onl > 0"""


@query("rollup_hour", f"WITH {ALL_LONG_SQL} {_sums(10)}")
def rollup_hour(spark, sf_dir):
    return rollup.sum_metrics(metric_table(spark, sf_dir), HOUR_KEY)


@query("rollup_day", f"WITH {ALL_LONG_SQL}, hours AS ({_sums(10)}) {_sums(8, 'hours')}")
def rollup_day(spark, sf_dir):
    # Sums nest, so the day needs no hour frame in between: one shuffle less, same rows.
    return rollup.sum_metrics(metric_table(spark, sf_dir), DAY_KEY)


@query(
    "rollup_online_percent",
    f"""WITH {GPS_LONG_SQL}, cells AS (SELECT * FROM gps_long)
SELECT * FROM ({_percent(10)}) UNION ALL SELECT * FROM ({_percent(8)})""",
)
def rollup_online_percent(spark, sf_dir):
    stored = metric_table(spark, sf_dir)
    return rollup.percent_of_sums(stored, HOUR_KEY).unionByName(rollup.percent_of_sums(stored, DAY_KEY))


@query(
    "rollup_frequent",
    f"""WITH {GPS_LONG_SQL}, cells AS (SELECT * FROM gps_long)
SELECT * FROM ({_frequency(10)}) UNION ALL SELECT * FROM ({_frequency(8)})""",
)
def rollup_frequent(spark, sf_dir):
    cells = metric_table(spark, sf_dir)
    return rollup.latest_frequency(cells, HOUR_KEY).unionByName(rollup.latest_frequency(cells, DAY_KEY))


@query(
    "rollup_period_filter",
    f"""WITH {ALL_LONG_SQL}
SELECT terminal_id, time_id, metric, value, '2024011512' AS period FROM cells
WHERE time_id LIKE strftime(TIMESTAMP '2024-01-15 13:20:00' - INTERVAL 1 HOUR, '%Y%m%d%H') || '%'
UNION ALL
SELECT terminal_id, time_id, metric, value, '20240114' FROM cells
WHERE time_id LIKE strftime(TIMESTAMP '2024-01-15 13:20:00' - INTERVAL 24 HOUR, '%Y%m%d') || '%'""",
)
def rollup_period_filter(spark, sf_dir):
    cells = metric_table(spark, sf_dir)
    hour = rollup.previous_period(ROLLUP_AS_OF, HOUR_KEY)
    day = rollup.previous_period(ROLLUP_AS_OF, DAY_KEY)
    return rollup.only_period(cells, hour).withColumn("period", F.lit(hour)).unionByName(
        rollup.only_period(cells, day).withColumn("period", F.lit(day))
    ).drop("day")


@query(
    "rollup_union_all",
    f"""WITH {ALL_LONG_SQL}
SELECT * FROM ({_frequency(10)}) UNION ALL SELECT * FROM ({_percent(10)}) UNION ALL SELECT * FROM ({_sums(10)})""",
)
def rollup_union_all(spark, sf_dir):
    return rollup.rollup(metric_table(spark, sf_dir), HOUR_KEY)


@query(
    "rollup_changed_periods",
    f"""WITH {GPS_LONG_SQL}, cells AS (SELECT * FROM gps_long)
SELECT * FROM ({_frequency(10)}) UNION ALL SELECT * FROM ({_percent(10)}) UNION ALL SELECT * FROM ({_sums(10)})""",
)
def rollup_changed_periods(spark, sf_dir):
    """Hours of the online points are rolled up; the buckets with offline points are written late, and only
    their hours are rolled up again."""
    path, hours = new_dir(spark, "cells"), new_dir(spark, "hours")
    points = gps_points(spark, sf_dir).withColumn("time_id", timekeys.time_id(F.col("ts")))
    is_late = F.col("online_status") == 0
    late = points.join(points.where(is_late).select("terminal_id", "time_id").distinct(), ["terminal_id", "time_id"], "left_semi")
    for part in (points.where(~is_late), late):
        wide = point_metrics.metrics_wide(part.drop("time_id"))
        cells.put_cells(cells.metric_text_cells(wide, GPS_METRIC_COLUMNS, F.lit(0).cast("bigint")), path)
        jobs.roll_up_changes(spark, path, hours, HOUR_KEY)
    return jobs.metrics_of_cells(cells.stored_cells(spark, hours)).drop("day")


@query("union_all_metrics", f"WITH {ALL_LONG_SQL} SELECT * FROM cells")
def union_all_metrics(spark, sf_dir):
    return all_metrics(spark, sf_dir)


@query(
    "cells_explode_rows",
    f"""WITH {CELLS_SQL}
SELECT split_part(row_key, '_', 1) AS terminal_id, substr(split_part(row_key, '_', 2), 1, 10) AS parent_id,
       qualifier AS metric, value
FROM cells""",
)
def cells_explode_rows(spark, sf_dir):
    return rollup.explode_cells(cell_table(spark, sf_dir), HOUR_KEY)
