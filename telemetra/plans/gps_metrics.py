"""GPS point metrics."""

from __future__ import annotations

from telemetra.operators import point_metrics as pm
from telemetra.plans.inputs import GPS_LONG_SQL, POINTS_SQL, WIDE_BY_USER_SQL, WIDE_SQL, gps_points, gps_points_by_user
from telemetra.plans.registry import query


def _count_sql(name: str, predicate: str) -> str:
    return f"""WITH {POINTS_SQL}
SELECT terminal_id, time_id, count(*) AS {name} FROM points WHERE {predicate} GROUP BY terminal_id, time_id"""


@query("gps_total_num", f"WITH {WIDE_SQL} SELECT terminal_id, time_id, gps_total_num FROM wide")
def gps_total_num(spark, sf_dir):
    return pm.total_metric(gps_points(spark, sf_dir))


@query("gps_frequent", f"WITH {WIDE_SQL} SELECT terminal_id, time_id, gps_frequent FROM wide")
def gps_frequent(spark, sf_dir):
    return pm.frequent_metric(gps_points(spark, sf_dir))


@query("gps_online_total", _count_sql("gps_online_total", "online_status = 1"))
def gps_online_total(spark, sf_dir):
    return pm.count_metric(gps_points(spark, sf_dir), "gps_online_total")


@query("gps_offline_total", _count_sql("gps_offline_total", "online_status = 0"))
def gps_offline_total(spark, sf_dir):
    return pm.count_metric(gps_points(spark, sf_dir), "gps_offline_total")


@query("gps_weak_num", _count_sql("gps_weak_num", "satellite_num > 0 AND satellite_num < 4"))
def gps_weak_num(spark, sf_dir):
    return pm.count_metric(gps_points(spark, sf_dir), "gps_weak_num")


@query("gps_not_open_num", _count_sql("gps_not_open_num", "satellite_num = -1"))
def gps_not_open_num(spark, sf_dir):
    return pm.count_metric(gps_points(spark, sf_dir), "gps_not_open_num")


@query("gps_zero_speed_num", _count_sql("gps_zero_speed_num", "speed = 0"))
def gps_zero_speed_num(spark, sf_dir):
    return pm.count_metric(gps_points(spark, sf_dir), "gps_zero_speed_num")


@query("gps_normal_num", _count_sql("gps_normal_num", "online_status = 1 AND satellite_num >= 4"))
def gps_normal_num(spark, sf_dir):
    return pm.count_metric(gps_points(spark, sf_dir), "gps_normal_num")


_PERCENT_SQL = f"""WITH {WIDE_SQL}
SELECT terminal_id, time_id, gps_online_percent FROM wide WHERE gps_online_percent IS NOT NULL"""


@query("gps_online_percent", _PERCENT_SQL)
def gps_online_percent(spark, sf_dir):
    return pm.percent_metric(gps_points(spark, sf_dir))


@query("gps_metrics_wide", f"WITH {WIDE_SQL} SELECT * FROM wide")
def gps_metrics_wide(spark, sf_dir):
    return pm.metrics_wide(gps_points(spark, sf_dir))


@query("gps_metrics_wide_by_user", f"WITH {WIDE_BY_USER_SQL} SELECT * FROM wide")
def gps_metrics_wide_by_user(spark, sf_dir):
    """One terminal per user, so that the number of keys grows with the events."""
    return pm.metrics_wide(gps_points_by_user(spark, sf_dir))


@query("gps_metrics_long", f"WITH {GPS_LONG_SQL} SELECT * FROM gps_long")
def gps_metrics_long(spark, sf_dir):
    return pm.metrics_long(gps_points(spark, sf_dir))


@query("metrics_pair_join", _PERCENT_SQL)
def metrics_pair_join(spark, sf_dir):
    points = gps_points(spark, sf_dir)
    return pm.percent_by_join(pm.total_metric(points), pm.count_metric(points, "gps_online_total"))


@query(
    "metrics_left_join_wide",
    f"""WITH {WIDE_SQL}
SELECT terminal_id, time_id, gps_frequent, gps_total_num,
       nullif(gps_online_total, 0) AS gps_online_total, nullif(gps_weak_num, 0) AS gps_weak_num,
       nullif(gps_not_open_num, 0) AS gps_not_open_num, nullif(gps_zero_speed_num, 0) AS gps_zero_speed_num,
       nullif(gps_offline_total, 0) AS gps_offline_total, nullif(gps_normal_num, 0) AS gps_normal_num,
       gps_online_percent
FROM wide""",
)
def metrics_left_join_wide(spark, sf_dir):
    return pm.wide_with_absent(gps_points(spark, sf_dir))
