from pyspark.sql import functions as F

from telemetra.operators import sessions as batch_sessions
from telemetra.ordering import Folder
from telemetra.streaming import metrics, parts, sessions, sinks
from telemetra.workspace import new_dir
from tests.conftest import rows

RECORD = "serial_num string, terminal_id string, ts timestamp, online_status int"


def records(spark, data):
    frame = spark.createDataFrame(data, "serial_num string, terminal_id string, ts string, online_status int")
    return frame.withColumn("ts", F.to_timestamp("ts"))


def arrive(frame, inbox):
    frame.write.mode("append").parquet(inbox)


BATCHES = [
    [("1", "t", "2024-01-01 00:00:00", 1), ("2", "t", "2024-01-01 00:01:00", 1), ("2", "t", "2024-01-01 00:02:00", 0)],
    [("1", "t", "2024-01-01 00:30:00", 0), ("3", "u", "2024-01-01 00:31:00", 1)],
    [("4", "u", "2024-01-03 00:00:00", 0)],
]


def gathered(spark, batches, work, inbox, checkpoint):
    for data in batches:
        frame = records(spark, data)
        arrive(frame, inbox)
        sinks.run_available(sessions.gather_sessions(sinks.parquet_stream(spark, frame.schema, inbox), work, checkpoint))


def assert_equals_batch(spark, work, batches):
    everything = records(spark, [r for b in batches for r in b])
    closed = sessions.read_pairs(spark, work).select("serial_num", "terminal_id", "start_ms", "end_ms", "record_count")
    assert rows(closed) == rows(batch_sessions.pair_sessions(everything))
    still_open = sessions.read_carry(spark, work).select("serial_num", "terminal_id", F.timestamp_millis("start_ms"), "online_status")
    assert rows(still_open) == rows(batch_sessions.unpaired_sessions(everything))


def test_live_sessions_survive_restarts_and_equal_batch(spark):
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")
    gathered(spark, BATCHES, work, inbox, f"{work}/checkpoint")
    assert_equals_batch(spark, work, BATCHES)
    assert rows(sessions.read_carry(spark, work).select("serial_num", "online_status")) == [("3", 1), ("4", 0)]


LATE = [
    [("1", "t", "2024-01-01 00:30:00", 0), ("1", "t", "2024-01-01 00:00:00", 1)],  # copies after the close
    [("3", "u", "2024-02-20 00:31:00", 0), ("3", "u", "2024-01-01 00:31:00", 1)],  # 50 days later
    [("4", "u", "2023-12-01 00:00:00", 1)],  # the connect comes last
]


def test_copies_long_sessions_and_late_records_equal_batch(spark):
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")
    gathered(spark, BATCHES, work, inbox, f"{work}/checkpoint")
    sessions.compact_sessions(spark, work)
    assert_equals_batch(spark, work, BATCHES)
    gathered(spark, LATE, work, inbox, f"{work}/checkpoint")
    assert_equals_batch(spark, work, BATCHES + LATE)
    sessions.compact_sessions(spark, work)
    assert_equals_batch(spark, work, BATCHES + LATE)
    assert sessions.read_carry(spark, work).count() == 0


def test_a_new_checkpoint_adds_to_the_old_one(spark):
    work, first, second = new_dir(spark, "t"), new_dir(spark, "in"), new_dir(spark, "in")
    gathered(spark, BATCHES[:1], work, first, f"{work}/one")
    gathered(spark, BATCHES[1:], work, second, f"{work}/two")
    assert_equals_batch(spark, work, BATCHES)


def test_a_mass_of_copies_is_one_row(spark):
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")
    hot = spark.range(0, 30_000, 1, 3).selectExpr(
        "'1' AS serial_num", "'t' AS terminal_id", "timestamp_millis(1704067200000 + (id % 2) * 60000) AS ts",
        "cast(1 - id % 2 AS int) AS online_status",
    )
    arrive(hot, inbox)
    sinks.run_available(
        sessions.gather_sessions(sinks.parquet_stream(spark, hot.schema, inbox), work, f"{work}/checkpoint")
    )
    assert spark.read.parquet(f"{work}/parts").count() == 1
    assert rows(sessions.read_pairs(spark, work).select("start_ms", "end_ms")) == [(1704067200000, 1704067260000)]


def test_late_points_are_dropped_and_windows_come_once(spark):
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")

    def points(*times):
        return records(spark, [("s", "t", t, 1) for t in times]).drop("serial_num")

    arrivals = [
        points("2024-01-01 00:01:00", "2024-01-01 00:05:00"),
        points("2024-01-01 01:00:00"),
        points("2024-01-01 00:06:00", "2024-01-01 00:55:00"),
        points("2024-01-01 02:00:00"),
    ]
    for part in arrivals:
        arrive(part, inbox)
        counted = metrics.tumbling_counts(sinks.parquet_stream(spark, part.schema, inbox))
        sinks.run_available(sinks.append_to_files(counted, f"{work}/out", f"{work}/checkpoint"))
    assert rows(spark.read.parquet(f"{work}/out")) == [
        ("t", "20240101000", 2), ("t", "20240101005", 1), ("t", "20240101010", 1)
    ]


def test_upserts_of_later_batches_win(spark):
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")
    for data in ([("1", "t", "2024-01-01 00:00:00", 1)], [("1", "t", "2024-01-01 00:05:00", 0)]):
        frame = records(spark, data)
        arrive(frame, inbox)
        counted = metrics.log_counts(sinks.parquet_stream(spark, frame.schema, inbox))
        sinks.run_available(sinks.upsert_to_files(counted, f"{work}/out", f"{work}/checkpoint"))
    current = sinks.read_upserts(spark, f"{work}/out", ["terminal_id", "time_id"])
    assert rows(current) == [("t", "20240101000", 1, 1)]


def test_preview_shows_the_first_rows_of_each_batch(spark):
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")
    for data in BATCHES:
        arrive(records(spark, data), inbox)
        stream = sinks.parquet_stream(spark, records(spark, data).schema, inbox)
        sinks.run_available(sinks.preview(stream, ["ts"], f"{work}/out", f"{work}/checkpoint", rows=1))
    assert rows(spark.read.parquet(f"{work}/out").select("serial_num")) == [("1",), ("1",), ("4",)]


def test_a_new_checkpoint_of_an_upsert_sink_wins(spark):
    """Three batches, then a new checkpoint on the same folder that has all records."""
    work, first, second = new_dir(spark, "t"), new_dir(spark, "in"), new_dir(spark, "in")
    data = [("1", "t", f"2024-01-01 00:0{i}:00", 1) for i in range(4)]

    def run(part, inbox, checkpoint):
        arrive(records(spark, part), inbox)
        counted = metrics.log_counts(sinks.parquet_stream(spark, records(spark, part).schema, inbox))
        sinks.run_available(sinks.upsert_to_files(counted, f"{work}/out", f"{work}/{checkpoint}"))
        return rows(sinks.read_upserts(spark, f"{work}/out", ["terminal_id", "time_id"]))

    for i in range(3):
        assert run(data[i : i + 1], first, "one") == [("t", "20240101000", i + 1, 0)]
    assert run(data, second, "two") == [("t", "20240101000", 4, 0)]
    for everything in (False, True, False):
        sinks.compact_upserts(spark, f"{work}/out", ["terminal_id", "time_id"], everything)
        assert rows(sinks.read_upserts(spark, f"{work}/out", ["terminal_id", "time_id"])) == [("t", "20240101000", 4, 0)]
    assert run([("2", "t", "2024-01-01 00:05:00", 0)], second, "two") == [("t", "20240101000", 4, 1)]


def test_a_compaction_writes_what_has_changed(spark):
    """Many sessions settle; a late record of one of them rewrites one row, and reads equal the batch."""
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")
    many = [(str(i), "t", f"2024-01-01 00:{i % 60:02d}:00", 1) for i in range(500)]
    few = [[("x", "u", "2024-01-02 00:00:00", 1)], [("x", "u", "2024-01-02 01:00:00", 0)], [("7", "t", "2024-01-03 00:00:00", 0)]]

    def written():
        version = parts.version_of(spark, work).number
        return spark.read.parquet(f"{work}/merged/version={version}").groupBy("place").count()

    batches, sizes = [], []
    for data in ([many], [few[0]], [few[1]], [few[2]], []):
        batches += data
        gathered(spark, data, work, inbox, f"{work}/checkpoint")
        sessions.compact_sessions(spark, work)
        assert_equals_batch(spark, work, batches)
        sizes.append(dict(map(tuple, written().collect())))
    assert sizes == [{"late": 500}, {"late": 501}, {"late": 1, "settled": 500}, {"late": 2}, {"late": 1, "settled": 1}]
    sessions.compact_sessions(spark, work, everything=True)
    assert_equals_batch(spark, work, batches)
    assert sum(r["count"] for r in written().collect()) == 501
    sessions.compact_sessions(spark, work)
    assert Folder(spark, f"{work}/parts").matching("run=*/batch=*") == []
    assert len(Folder(spark, f"{work}/upto").matching("version=*")) == 2
    assert_equals_batch(spark, work, batches)


def test_a_batch_being_written_is_left_for_the_next_compaction(spark):
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")
    gathered(spark, BATCHES, work, inbox, f"{work}/checkpoint")
    folder = Folder(spark, f"{work}/parts")
    last = sorted(folder.matching("run=*/batch=*"))[-1]
    folder.remove(f"{last}/_SUCCESS")
    sessions.compact_sessions(spark, work)
    assert len(parts.version_of(spark, work).upto) == 1 and max(parts.version_of(spark, work).upto.values()) == len(BATCHES) - 2
    assert_equals_batch(spark, work, BATCHES)


def test_arrivals_count_copies_once_and_take_late_scans(spark):
    work, inbox = new_dir(spark, "t"), new_dir(spark, "in")
    schema = "waybill_no string, bar_record_id string, zone_code string, ordinal long, scan string"

    def scans(*times):
        return spark.createDataFrame([(w, "b", "z", 1, f"2024-01-01 {t}:00") for w, t in times], schema).select(
            "waybill_no", "bar_record_id", "zone_code", "ordinal", F.to_timestamp("scan").alias("bar_scan_tm")
        )

    arrivals = [scans(("1", "00:01"), ("1", "00:01"), ("2", "00:29")), scans(("1", "00:01"), ("3", "00:20")), scans(("4", "02:00")), scans(("5", "00:03"), ("6", "05:00"))]
    for part in arrivals:
        arrive(part, inbox)
        counted = metrics.zone_arrivals(sinks.parquet_stream(spark, part.schema, inbox))
        sinks.run_available(sinks.append_to_files(counted, f"{work}/out", f"{work}/checkpoint"))
    assert rows(spark.read.parquet(f"{work}/out")) == [("z", "202401010000", 3), ("z", "202401010200", 1)]
