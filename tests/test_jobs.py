"""The live and roll-up jobs from raw lines to stored cells; keys in UTC+8."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telemetra import jobs, ordering
from telemetra.operators import cells
from telemetra.schemas import DAY_KEY, HOUR_KEY
from telemetra.sources import lines as src
from telemetra.sources.lines import text_file_stream
from telemetra.streaming import late
from telemetra.streaming.sinks import run_available
from telemetra.workspace import new_dir
from tests.conftest import rows
from tests.test_messages import TWO_ENVELOPES, envelope, point
from tests.test_sessions import AS_OF, OLD_LOG, seconds_of


def write_lines(spark, lines, path):
    spark.createDataFrame([(t,) for t in lines], "value string").write.mode("append").text(path)


def value_of(spark, table, key, qualifier):
    found = cells.latest_cells(cells.read_cells(spark, table)).where((F.col("row_key") == key) & (F.col("qualifier") == qualifier))
    return [r.value for r in found.collect()]


def test_lines_to_cells_to_hours_and_days(spark_utc8):
    spark, inbox, table, hours, days, work = spark_utc8, *[new_dir(spark_utc8, n) for n in ("in", "cells", "hours", "days", "work")]
    later = envelope("1116751", [point("2018-04-17 12:09:58.0", "3.00", "6", "1"), point("2018-04-17 12:10:01.0", "3.00", "6", "1")])
    for batch in (TWO_ENVELOPES, [later]):
        write_lines(spark, batch, inbox)
        run_available(jobs.live_gps_metrics(text_file_stream(spark, inbox), table, work, delay="2 hours"))
    assert value_of(spark, table, "1116751_20180417120", "gpsOnlineTotal") == ["3"]
    assert value_of(spark, table, "1116751_20180417120", "gpsOnlinePercent") == ["0.2"]
    assert value_of(spark, table, "1116751_20180417121", "gpsNormalNum") == ["1"]
    assert value_of(spark, table, "1116751_20180417121", "gpsOfflineTotal") == []

    assert jobs.roll_up_previous(spark, table, hours, datetime(2018, 4, 17, 13, 5), HOUR_KEY)
    assert value_of(spark, hours, "1116751_2018041712", "gpsOnlineTotal") == ["4"]
    assert value_of(spark, hours, "1116751_2018041712", "gpsTotalNum") == ["18"]
    assert value_of(spark, hours, "1116751_2018041712", "gpsOnlinePercent") == ["0.22"]
    assert value_of(spark, hours, "1116996_2018041713", "gpsTotalNum") == []
    assert jobs.roll_up_previous(spark, table, hours, datetime(2018, 4, 17, 14, 0), HOUR_KEY)
    assert value_of(spark, hours, "1116996_2018041713", "gpsOnlinePercent") == ["0.33"]
    assert not jobs.roll_up_previous(spark, table, hours, datetime(2018, 4, 17, 23, 0), HOUR_KEY)

    assert jobs.roll_up_previous(spark, hours, days, datetime(2018, 4, 18, 0, 1), DAY_KEY)
    assert value_of(spark, days, "1116751_20180417", "gpsTotalNum") == ["18"]
    assert value_of(spark, days, "1116996_20180417", "gpsTotalNum") == ["3"]


def test_log_lines_to_counts_and_seconds(spark_utc8):
    spark, inbox, table, sessions, work = spark_utc8, *[new_dir(spark_utc8, n) for n in ("in", "cells", "sessions", "work")]
    lines = [f"serialNum:{s},terminalId:{t},time:{ms},online:{on},serverIp:1.1.1.1" for s, t, ms, on in OLD_LOG]
    for batch in (lines[:4], lines[4:]):
        write_lines(spark, batch, inbox)
        run_available(jobs.live_log_counts(text_file_stream(spark, inbox), table, f"{work}/counts", delay="1 day"))
        run_available(jobs.live_sessions(text_file_stream(spark, inbox), sessions, f"{work}/sessions"))
    assert value_of(spark, table, "8_20180328020", "gpsLogCloseNum") == ["1"]
    assert value_of(spark, table, "8_20180328020", "gpsLogConnectNum") == []
    seconds = jobs.connected_seconds(spark, sessions, AS_OF)
    assert seconds_of(seconds, "7") == {"20180328011": 50}
    assert sum(seconds_of(seconds, "8").values()) == 3110
    assert sum(seconds_of(seconds, "5").values()) == 2091


def cell(spark, key, value, order):
    day = key.rsplit("_", 1)[1][:8]
    return spark.createDataFrame([(key, "m", value, order, day)], "row_key string, qualifier string, value string, write_ts long, day string")


def test_equal_orders_go_by_number_and_a_second_roll_up_wins(spark_utc8):
    spark, table, hours = spark_utc8, new_dir(spark_utc8, "cells"), new_dir(spark_utc8, "hours")
    both = cell(spark, "t_1_20180417120", "9", 1).unionByName(cell(spark, "t_1_20180417120", "10", 1))
    assert [r.value for r in cells.latest_cells(both).collect()] == ["10"]
    as_of = datetime(2018, 4, 17, 13, 5)
    for value, order in (("9", 1), ("10", 2), ("8", 3)):
        cells.append_cells(cell(spark, "t_1_20180417120", value, order), table)
        assert jobs.roll_up_previous(spark, table, hours, as_of, HOUR_KEY)
        assert value_of(spark, hours, "t_1_2018041712", "m") == [value]


def test_a_new_checkpoint_writes_over_the_old_run(spark_utc8):
    spark, table, work = spark_utc8, new_dir(spark_utc8, "cells"), new_dir(spark_utc8, "work")
    first, second = new_dir(spark, "in"), new_dir(spark, "in")

    def message(n, second=0):
        return envelope("7", [point(f"2018-04-17 12:0{i % 10}:{second + i // 10:02d}.0", "3.00", "6", "1") for i in range(n)])

    for i in range(3):
        write_lines(spark, [message(1, i)], first)
        run_available(jobs.live_gps_metrics(text_file_stream(spark, first), table, f"{work}/one", delay="2 hours"))
    assert value_of(spark, table, "7_20180417120", "gpsOnlineTotal") == ["3"]
    write_lines(spark, [message(12)], second)
    run_available(jobs.live_gps_metrics(text_file_stream(spark, second), table, f"{work}/two", delay="2 hours"))
    assert value_of(spark, table, "7_20180417120", "gpsOnlineTotal") == ["12"]


def test_stored_deletes_and_compaction(spark_utc8):
    spark, table, target = spark_utc8, new_dir(spark_utc8, "cells"), new_dir(spark_utc8, "target")
    for order in (1, 2, 3):
        for key in ("a_20180417120", "b_20180417120", "c_20180418120"):
            cells.append_cells(cell(spark, key, str(order), order), table)
    keys = spark.createDataFrame([("a_20180417120",), ("c_20180418120",), ("c_20180418120",)], "row_key string")
    cells.delete_stored_rows(keys, table, 4)
    cells.append_cells(cell(spark, "c_20180418120", "9", 5), table)
    expected = [("b_20180417120", "3"), ("c_20180418120", "9")]
    assert rows(cells.stored_cells(spark, table).select("row_key", "value")) == expected
    cells.compact_days(spark, table, target)
    assert rows(cells.read_cells(spark, target).select("row_key", "value")) == expected
    assert len(cells.read_cells(spark, target).inputFiles()) == 2


def test_all_log_metrics_reach_the_day(spark_utc8):
    spark = spark_utc8
    inbox, table, hours, days, sessions, rejects, work = (new_dir(spark, n) for n in "in cells hours days sessions rejects work".split())
    lines = [f"serialNum:{s},terminalId:{t},time:{ms},online:{on},serverIp:1.1.1.1" for s, t, ms, on in OLD_LOG]
    bad = "serialNum:9,terminalId:9,time:999999999999999,online:1,serverIp:1.1.1.1"
    write_lines(spark, [*lines, bad, lines[1]], inbox)
    stream = lambda: text_file_stream(spark, inbox)
    run_available(jobs.live_log_counts(stream(), table, f"{work}/counts", delay="1 day"))
    run_available(jobs.live_sessions(stream(), sessions, f"{work}/sessions"))
    run_available(jobs.live_rejects(stream(), rejects, f"{work}/rejects"))
    assert [tuple(r) for r in spark.read.parquet(rejects).collect()] == [("log", bad, None)]
    for _ in range(2):
        jobs.store_connected_seconds(spark, sessions, table, AS_OF)
    assert value_of(spark, table, "7_20180328011", "gpsLogConnectionDuration") == ["50"]
    for hour in range(24):
        jobs.roll_up_previous(spark, table, hours, datetime(2018, 3, 28, hour, 5), HOUR_KEY)
    assert jobs.roll_up_previous(spark, hours, days, datetime(2018, 3, 29, 0, 1), DAY_KEY)
    for metric, value in (("gpsLogConnectionDuration", "3110"), ("gpsLogConnectNum", "1"), ("gpsLogCloseNum", "1")):
        assert value_of(spark, days, "8_20180328", metric) == [value]


def test_late_lines_are_counted_by_the_correction(spark_utc8):
    spark, inbox, table, work = spark_utc8, *[new_dir(spark_utc8, n) for n in ("in", "cells", "work")]
    for time in ("2018-04-17 12:01:00.0", "2018-04-17 15:00:00.0", "2018-04-17 12:02:00.0"):
        write_lines(spark, [envelope("7", [point(time, "3.00", "6", "1")])], inbox)
        run_available(jobs.live_gps_metrics(text_file_stream(spark, inbox), table, work, delay="10 minutes"))
    assert value_of(spark, table, "7_20180417120", "gpsOnlineTotal") == ["1"]
    jobs.correct_gps_metrics(spark.read.text(inbox), table)
    assert value_of(spark, table, "7_20180417120", "gpsOnlineTotal") == ["2"]
    closes = "serialNum:1,terminalId:7,time:1523937660000,online:0,serverIp:1.1.1.1"
    jobs.correct_log_counts(spark.createDataFrame([(closes,)], "value string"), table)
    assert value_of(spark, table, "7_20180417120", "gpsLogCloseNum") == ["1"]


def test_a_live_write_after_a_delete_or_a_correction_is_read(spark_utc8):
    """One run before and after: what the batch writes last is what is read."""
    spark, inbox, table, work = spark_utc8, *[new_dir(spark_utc8, n) for n in ("in", "cells", "work")]
    key = "7_20180417120"

    def live(*seconds):
        write_lines(spark, [envelope("7", [point(f"2018-04-17 12:01:{s:02d}.0", "3.00", "6", "1") for s in seconds])], inbox)
        run_available(jobs.live_gps_metrics(text_file_stream(spark, inbox), table, work, delay="2 hours"))
        stored = cells.stored_cells(spark, table).where((F.col("row_key") == key) & (F.col("qualifier") == "gpsOnlineTotal"))
        return [r.value for r in stored.collect()]

    assert live(1, 2) == ["2"]
    cells.delete_stored_rows(spark.createDataFrame([(key,)], "row_key string"), table)
    assert cells.stored_cells(spark, table).count() == 0
    assert live(3) == ["3"]
    jobs.correct_gps_metrics(spark.read.text(inbox), table)
    assert live(4, 5) == ["5"]


def test_numbers_do_not_follow_the_clock(spark_utc8, monkeypatch):
    spark, table = spark_utc8, new_dir(spark_utc8, "cells")
    cells.append_cells(cell(spark, "a_20180417120", "1", 10**15), table)
    assert cells.put_cells(cell(spark, "a_20180417120", "2", 0), table) == 10**15 + 1
    monkeypatch.setattr(ordering.time, "time", lambda: 0.0)
    assert cells.put_cells(cell(spark, "a_20180417120", "3", 0), table) == 10**15 + 2
    assert value_of(spark, table, "a_20180417120", "m") == ["3"]


def test_numbers_are_taken_once_and_old_ones_go(spark_utc8, monkeypatch):
    spark, path = spark_utc8, new_dir(spark_utc8, "numbers")
    monkeypatch.setattr(ordering, "KEPT", 5)
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda _: ordering.take_number(spark, path), range(20)))
    assert sorted(numbers) == list(range(1, 21))
    assert len(ordering.taken(ordering.orders(spark, path))) <= 6
    # A writer that has looked long ago finds the old places empty and still gets the newest number.
    monkeypatch.setattr(ordering, "taken", lambda folder, seen=iter([{3: (0, True)}]), real=ordering.taken: next(seen, None) or real(folder))
    assert ordering.take_number(spark, path) == 21


def test_open_writes_hold_back_what_counts_as_complete(spark_utc8):
    spark, path = spark_utc8, new_dir(spark_utc8, "numbers")
    first, second = (ordering.take_number(spark, path) for _ in range(2))
    ordering.complete(spark, path, second)
    assert ordering.complete_up_to(spark, path) == 0
    assert ordering.complete_up_to(spark, path, grace=0.0) == second
    ordering.complete(spark, path, first)
    assert ordering.complete_up_to(spark, path) == second


def put(spark, table, *values):
    """A write of ``(key, qualifier, value)`` cells."""
    rows_of = [(key, name, value, 0, key.rsplit("_", 1)[1][:8]) for key, name, value in values]
    return cells.put_cells(spark.createDataFrame(rows_of, "row_key string, qualifier string, value string, write_ts long, day string"), table)


def test_only_changed_periods_are_rolled_up_again(spark_utc8):
    spark, table, hours, days = spark_utc8, *[new_dir(spark_utc8, n) for n in ("cells", "hours", "days")]
    keys = [f"{t}_20180417{hour}{part}" for t in "ab" for hour in (12, 13) for part in (0, 3)]
    put(spark, table, *[(key, name, "2") for key in keys for name in ("gpsTotalNum", "gpsOnlineTotal")])
    assert jobs.roll_up_changes(spark, table, hours, HOUR_KEY) == 4
    assert jobs.roll_up_changes(spark, table, hours, HOUR_KEY) == 0
    assert jobs.roll_up_changes(spark, hours, days, DAY_KEY) == 2
    orders = {r.row_key: r.write_ts for r in cells.stored_cells(spark, hours).collect()}

    put(spark, table, ("a_20180417123", "gpsTotalNum", "7"))
    assert jobs.roll_up_changes(spark, table, hours, HOUR_KEY) == 1
    assert jobs.roll_up_changes(spark, hours, days, DAY_KEY) == 1
    assert value_of(spark, hours, "a_2018041712", "gpsTotalNum") == ["9"]
    assert value_of(spark, days, "a_20180417", "gpsTotalNum") == ["13"]
    after = {r.row_key: r.write_ts for r in cells.stored_cells(spark, hours).collect()}
    assert [key for key in orders if after[key] != orders[key]] == ["a_2018041712"]

    # A deleted bucket, and one that was its hour's last: the hour goes too.
    cells.delete_stored_rows(spark.createDataFrame([("b_20180417120",), ("a_20180417130",), ("a_20180417133",)], "row_key string"), table)
    assert jobs.roll_up_changes(spark, table, hours, HOUR_KEY) == 2
    jobs.roll_up_changes(spark, hours, days, DAY_KEY)
    for target, length in ((hours, HOUR_KEY), (days, DAY_KEY)):
        whole = jobs.rollup.rollup(jobs.metrics_of_cells(cells.stored_cells(spark, table)), length)
        kept = jobs.metrics_of_cells(cells.stored_cells(spark, target)).drop("day")
        assert rows(kept) == rows(whole)


def test_a_write_that_has_not_ended_is_rolled_up_later(spark_utc8):
    spark, table, hours = spark_utc8, new_dir(spark_utc8, "cells"), new_dir(spark_utc8, "hours")
    put(spark, table, ("a_20180417120", "gpsTotalNum", "1"))
    slow = cells.next_order(spark, table)
    put(spark, table, ("b_20180417120", "gpsTotalNum", "1"))
    assert jobs.roll_up_changes(spark, table, hours, HOUR_KEY) == 1
    cells.append_cells(cell(spark, "c_20180417120", "5", slow), table)
    ordering.complete(spark, table, slow)
    assert jobs.roll_up_changes(spark, table, hours, HOUR_KEY) == 2
    assert value_of(spark, hours, "c_2018041712", "m") == ["5"]


def test_late_points_are_listed_and_counted(spark_utc8):
    """Late ones in three batches; what the correction leaves equals a batch over all points, also after a restart."""
    spark, inbox, table, work = spark_utc8, *[new_dir(spark_utc8, n) for n in ("in", "cells", "work")]
    times = ["12:01:00", "15:00:00", "12:02:00", "14:55:00", "12:03:00", "16:00:00", "14:56:00"]
    for i, time in enumerate(times):
        write_lines(spark, [envelope(str(i % 2), [point(f"2018-04-17 {time}.0", "3.00", "6", "1")])], inbox)
        points = lambda: src.parse_gps_lines(src.clean_lines(text_file_stream(spark, inbox)))
        run_available(jobs.live_gps_metrics(text_file_stream(spark, inbox), table, f"{work}/cells", delay="10 minutes"))
        run_available(late.gather_late(points(), f"{work}/late", f"{work}/late-checkpoint"))
        if i == 4:
            kept = src.parse_gps_lines(src.clean_lines(spark.read.text(inbox))).drop("raw_time")
            assert jobs.correct_late_points(kept, f"{work}/late", table) > 0
    kept = src.parse_gps_lines(src.clean_lines(spark.read.text(inbox))).drop("raw_time")
    assert jobs.correct_late_points(kept, f"{work}/late", table) > 0
    assert jobs.correct_late_points(kept, f"{work}/late", table) == 0
    whole = cells.metric_text_cells(jobs.metrics_wide(kept), jobs.GPS_METRIC_COLUMNS, F.lit(0).cast("bigint"))
    columns = ["row_key", "qualifier", "value"]
    assert rows(cells.stored_cells(spark, table).select(*columns)) == rows(whole.select(*columns))


def test_pages_stay_as_they_were_numbered(spark_utc8):
    spark, table, index = spark_utc8, new_dir(spark_utc8, "cells"), new_dir(spark_utc8, "pages")
    put(spark, table, *[(f"t{i}_20180417120", "m", "1") for i in range(6)])
    cells.index_pages(spark, table, 2, index)
    assert cells.indexed_page(spark, table, index, 1, 2, only_current=True)[1].has_next
    seen = [r.row_key for r in cells.indexed_page(spark, table, index, 1, 2)[0].collect()]
    put(spark, table, ("t00_20180417120", "m", "1"), ("t3_20180417120", "m", "9"))
    cells.delete_stored_rows(spark.createDataFrame([("t5_20180417120",)], "row_key string"), table)
    for page in (2, 3):
        seen += [r.row_key for r in cells.indexed_page(spark, table, index, page, 2)[0].collect()]
    assert sorted(seen) == [f"t{i}_20180417120" for i in range(6)]
    with pytest.raises(cells.StalePages):
        cells.indexed_page(spark, table, index, 2, 2, only_current=True)
