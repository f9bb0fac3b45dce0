from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from telemetra.operators import cells, numbering, rollup
from telemetra.operators import point_metrics as pm
from telemetra.plans.inputs import gps_points
from telemetra.schemas import DAY_KEY, HOUR_KEY
from telemetra.workspace import new_dir, shared_dir
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


def long_frame(spark, data):
    return spark.createDataFrame(data, "terminal_id string, time_id string, metric string, value double")


TEN_MINUTES = [
    ("7", "20180328011", "gpsTotalNum", 15.0), ("7", "20180328012", "gpsTotalNum", 3.0),
    ("7", "20180328011", "gpsOnlineTotal", 5.0), ("7", "20180328012", "gpsOnlineTotal", 1.0),
    ("7", "20180328011", "gpsOnlinePercent", 0.33), ("7", "20180328012", "gpsOnlinePercent", 0.33),
    ("7", "20180328011", "gpsFrequent", 1.0), ("7", "20180328012", "gpsFrequent", 0.0),
    ("7", "20180328020", "gpsTotalNum", 15.0), ("7", "20180328020", "gpsFrequent", 1.0),
    ("7", "20180328011", "gpsLogConnectionDuration", 50.0), ("7", "20180328012", "gpsLogConnectionDuration", 600.0),
]


def test_hour_rollup(spark):
    assert rows(rollup.rollup(long_frame(spark, TEN_MINUTES), HOUR_KEY).select("time_id", "metric", "value")) == [
        ("2018032801", "gpsFrequent", 0.0),
        ("2018032801", "gpsLogConnectionDuration", 650.0),
        ("2018032801", "gpsOnlinePercent", 0.33),
        ("2018032801", "gpsOnlineTotal", 6.0),
        ("2018032801", "gpsTotalNum", 18.0),
        ("2018032802", "gpsFrequent", 1.0),
        ("2018032802", "gpsTotalNum", 15.0),
    ]


def test_day_from_hours_equals_day_from_ten_minutes(spark):
    frame = long_frame(spark, TEN_MINUTES)
    hours = rollup.rollup(frame, HOUR_KEY)
    assert rows(rollup.rollup(hours, DAY_KEY)) == rows(rollup.rollup(frame, DAY_KEY))


def test_previous_periods(spark):
    assert rollup.previous_period(datetime(2018, 3, 1, 0, 30), HOUR_KEY) == "2018022823"
    assert rollup.previous_period(datetime(2018, 3, 1, 0, 30), DAY_KEY) == "20180228"
    with pytest.raises(ValueError):
        rollup.previous_period(datetime(2018, 3, 1), 4)


def test_point_counts_are_consistent(spark):
    points = gps_points(spark, SF_DIR)
    counted = pm.counts(points)
    assert counted.where("gps_online_total + gps_offline_total <> n").count() == 0
    wide = pm.metrics_wide(points)
    assert wide.where("gps_online_percent < 0 OR gps_online_percent > 1").count() == 0
    assert counted.agg(F.sum("n")).first()[0] == points.count()


# ---- cells -------------------------------------------------------------------------------


def cell_frame(spark, data):
    frame = spark.createDataFrame(data, "row_key string, qualifier string, value string, write_ts long")
    return frame.withColumn("day", cells.day_of_key(F.col("row_key")))


WRITES = [
    ("a_20180328011", "x", "1", 1), ("a_20180328011", "x", "2", 3), ("a_20180328011", "x", "3", 2),
    ("a_20180328011", "y", "9", 1), ("b_20180329000", "x", "5", 1), ("c_20180329001", "x", "6", 1),
]


@pytest.fixture
def stored(spark):
    path = new_dir(spark, "test-cells")
    cells.append_cells(cell_frame(spark, WRITES[:2]), path)
    cells.append_cells(cell_frame(spark, WRITES[2:]), path)
    return cells.read_cells(spark, path)


def plain(df):
    return rows(df.select("row_key", "qualifier", "value", "write_ts"))


def test_last_write_wins(stored):
    assert plain(cells.latest_cells(stored)) == [
        ("a_20180328011", "x", "2", 3), ("a_20180328011", "y", "9", 1), ("b_20180329000", "x", "5", 1), ("c_20180329001", "x", "6", 1)
    ]


def test_upsert_replaces_and_adds(spark, stored):
    incoming = cell_frame(spark, [("b_20180329000", "x", "7", 2), ("d_20180401000", "z", "8", 2), ("a_20180328011", "x", "old", 0)])
    merged = cells.upsert_cells(stored, incoming)
    assert [(r.row_key[0], r.value) for r in merged.where("qualifier <> 'y'").orderBy("row_key").collect()] == [
        ("a", "2"), ("b", "7"), ("c", "6"), ("d", "8")
    ]


def test_versions(stored):
    newest = cells.newest_versions(stored, 2).where("row_key = 'a_20180328011' AND qualifier = 'x'")
    assert [(r.value, r.version) for r in newest.orderBy("version").collect()] == [("2", 1), ("3", 2)]
    assert plain(cells.newest_versions(stored, 0)) == plain(cells.latest_cells(stored))
    assert cells.newest_versions(stored, 2**31 - 1).count() == len(WRITES)


def test_reads_and_deletes(spark, stored):
    keys = spark.createDataFrame([("a_20180328011",), ("a_20180328011",), ("zz",)], "row_key string")
    assert cells.get_rows(stored, keys).count() == 4
    assert {r.row_key for r in cells.delete_rows(stored, keys).collect()} == {"b_20180329000", "c_20180329001"}
    assert cells.delete_one_row(stored, "b_20180329000").count() == 5
    assert plain(cells.get_row(stored, "b_20180329000")) == [("b_20180329000", "x", "5", 1)]
    assert plain(cells.first_row(stored, F.col("row_key") > "b")) == [("b_20180329000", "x", "5", 1)]
    assert cells.first_row(stored, F.col("row_key") > "x").count() == 0
    assert plain(cells.scan_range(stored, "b_20180329000", "c_20180329001")) == [("b_20180329000", "x", "5", 1)]


def test_null_key_is_an_error(spark, stored):
    keys = spark.createDataFrame([("a_20180328011",), (None,)], "row_key string")
    with pytest.raises(PySparkException, match="must not be null"):
        cells.get_rows(stored, keys).collect()


def test_point_read_visits_one_folder(stored):
    plan = cells.get_row(stored, "b_20180329000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "20180329" in plan
    assert "PushedFilters: [IsNotNull(row_key), EqualTo(row_key,b_20180329000)]" in plan


def test_version_limit_runs_before_the_shuffle(stored):
    plan = cells.newest_versions(stored, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_paging(spark):
    frame = cell_frame(spark, [(f"t_2018032{i // 10}{i % 10:03d}", q, str(i), 1) for i in range(25) for q in "xy"])
    page, seen = cells.Page(size=10), []
    while page.has_next:
        content, page = cells.next_page(frame, page)
        keys = sorted({r.row_key for r in content.collect()})
        seen.append((page.index, len(keys), page.first_row_index, page.previous_index, page.next_index, page.rows_seen))
        assert content.count() == 2 * len(keys)
        assert (keys[0], keys[-1]) == (page.first_key, page.last_key)
    assert seen == [(1, 10, 1, 1, 2, 10), (2, 10, 11, 1, 3, 20), (3, 5, 21, 2, 4, 25)]
    info = cells.page_info(frame, 10).orderBy("page_index").collect()
    assert [(r.page_index, r.row_count, r.first_row_index, r.previous_index, r.next_index, r.rows_seen) for r in info] == seen
    assert [r.has_next for r in info] == [True, True, False]


def test_page_with_stop_key_and_condition(spark):
    frame = cell_frame(spark, [(f"t_{i:02d}", "x", str(i), 1) for i in range(20)])
    content, page = cells.next_page(frame, cells.Page(size=3), "t_04", "t_09", F.col("value").cast("int") % 2 == 0)
    assert sorted(r.row_key for r in content.collect()) == ["t_04", "t_06", "t_08"]
    content, page = cells.next_page(frame, page, "t_04", "t_09", F.col("value").cast("int") % 2 == 0)
    assert content.count() == 0 and page.rows_seen == 3 and not page.has_next


def test_row_numbers_are_consecutive_even_for_equal_rows(spark):
    frame = spark.range(0, 5000, 1, 7).selectExpr("if(id % 3 = 0, 1, id % 11) AS k")
    numbered = numbering.with_row_number(frame, [F.col("k")], "n", partitions=6, may_tie=True).collect()
    assert sorted(r.n for r in numbered) == list(range(1, 5001))
    in_order = [r.k for r in sorted(numbered, key=lambda r: r.n)]
    assert in_order == sorted(in_order)


def test_wide_rows_become_nine_cells(spark):
    wide = pm.metrics_wide(gps_points(spark, SF_DIR))
    put = cells.cells_of_wide_rows(wide, F.lit(1))
    assert put.count() == 9 * wide.count()
    sample = put.first()
    assert len(sample.row_key.split("_")[0]) == 11


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert new_dir(spark, "a") != new_dir(spark, "a")
    assert new_dir(spark, "a").startswith(shared_dir(spark) + "/a-")
