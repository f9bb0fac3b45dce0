"""Session pairing and connected seconds with hand-derived results; keys in UTC+8."""

import random
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from telemetra.operators import sessions as ops
from tests.conftest import rows

AS_OF = datetime(2018, 3, 28, 15, 4, 0)


def records(spark, data):
    frame = spark.createDataFrame(data, "serial_num string, terminal_id string, ms long, online_status int")
    return frame.select("serial_num", "terminal_id", F.timestamp_millis("ms").alias("ts"), "online_status")


def millis(text):
    """Epoch millis of UTC+8 wall-clock text."""
    return int((datetime.fromisoformat(text) - datetime(1970, 1, 1, 8)).total_seconds() * 1000)


OLD_LOG = [
    ("151965923", "5", 1522218909000, 1),
    ("151965925", "7", 1522170909000, 1), ("151965925", "7", 1522170959000, 0),
    ("151965926", "8", 1522170909000, 1), ("151965926", "8", 1522174019000, 0),
    ("151965927", "9", 1522163709000, 1), ("151965927", "9", 1522166819000, 0),
]


def seconds_of(df, terminal):
    return {r.time_id: r.duration_seconds for r in df.where(F.col("terminal_id") == terminal).collect()}


def test_connected_seconds(spark_utc8):
    total = ops.duration_total(records(spark_utc8, OLD_LOG), AS_OF)
    assert seconds_of(total, "7") == {"20180328011": 50}
    assert seconds_of(total, "8") == {
        "20180328011": 291, "20180328012": 600, "20180328013": 600, "20180328014": 600, "20180328015": 600, "20180328020": 419,
    }
    assert seconds_of(total, "9") == {
        "20180327231": 291, "20180327232": 600, "20180327233": 600, "20180327234": 600, "20180327235": 600, "20180328000": 419,
    }
    assert seconds_of(total, "5") == {
        "20180328143": 291, "20180328144": 600, "20180328145": 600, "20180328150": 600,
    }


def test_parts_add_up_to_the_total(spark_utc8):
    frame = records(spark_utc8, OLD_LOG)
    parts = ops.duration_same_bucket(frame).unionByName(ops.duration_cross_bucket(frame)).unionByName(ops.duration_open(frame, AS_OF))
    summed = parts.groupBy("terminal_id", "time_id").agg(F.sum("duration_seconds").alias("duration_seconds"))
    assert rows(summed) == rows(ops.duration_total(frame, AS_OF))


def test_connects_closes_and_requeue(spark_utc8):
    frame = records(spark_utc8, OLD_LOG)
    assert rows(ops.connect_num(frame)) == [
        ("5", "20180328143", 1), ("7", "20180328011", 1), ("8", "20180328011", 1), ("9", "20180327231", 1)
    ]
    assert rows(ops.close_num(frame)) == [("7", "20180328011", 1), ("8", "20180328020", 1), ("9", "20180328000", 1)]
    assert [r.value for r in ops.requeue_lines(frame).collect()] == [
        "serialNum:151965923,terminalId:5,time:1522218909000,online:1,serverIp:111.111.111.111"
    ]


def test_long_metrics(spark_utc8):
    long = ops.metrics_long(records(spark_utc8, OLD_LOG), AS_OF).where("terminal_id = '7'")
    assert rows(long.select("metric", "value")) == [
        ("gpsLogCloseNum", 1.0), ("gpsLogConnectNum", 1.0), ("gpsLogConnectionDuration", 50.0)
    ]


@pytest.mark.parametrize(
    "start, end, buckets, first, last",
    [
        ("2018-03-05 00:03:00", "2018-03-05 00:13:00", 2, "20180305000", "20180305001"),
        ("2018-03-31 23:55:00", "2018-04-01 00:05:00", 2, "20180331235", "20180401000"),
        ("2018-04-08 21:14:00", "2018-04-11 00:01:00", 306, "20180408211", "20180411000"),
        ("2018-04-08 22:41:00", "2018-04-09 00:00:00", 9, "20180408224", "20180409000"),
    ],
    ids=["day below ten", "month end", "three days", "ends on a bucket start"],
)
def test_calendar_edges(spark_utc8, start, end, buckets, first, last):
    frame = records(spark_utc8, [("1", "t", millis(start), 1), ("1", "t", millis(end), 0)])
    seconds = seconds_of(ops.duration_total(frame, AS_OF), "t")
    assert len(seconds) == buckets
    assert (min(seconds), max(seconds)) == (first, last)
    assert sum(seconds.values()) == (millis(end) - millis(start)) // 1000
    series = ops.bucket_series(ops.pair_sessions(frame), F.col("end_ms"), F.col("start_ms"), ["serial_num"])
    assert {r.time_id for r in series.collect()} == set(seconds)


def test_three_records_keep_first_and_last(spark_utc8):
    frame = records(spark_utc8, [("1", "t", 1522170959000, 0), ("1", "t", 1522170909000, 1), ("1", "t", 1522170930000, 1)])
    assert rows(ops.pair_sessions(frame)) == [("1", "t", 1522170909000, 1522170959000, 3)]
    assert rows(ops.pair_by_join(frame)) == [("1", "t", 1522170909000, 1522170959000)]
    assert ops.unpaired_sessions(frame).count() == 0


def test_lone_close_accrues_only_on_request(spark_utc8):
    frame = records(spark_utc8, [("1", "t", 1522218909000, 0)])
    assert ops.duration_total(frame, AS_OF).count() == 0
    assert seconds_of(ops.duration_open(frame, AS_OF, accrue_lone_close=True), "t")["20180328143"] == 291


def test_session_opened_after_as_of_has_no_seconds_yet(spark_utc8):
    frame = records(spark_utc8, [("1", "t", millis("2018-03-28 15:10:00"), 1)])
    assert ops.duration_total(frame, AS_OF).count() == 0
    frame = records(spark_utc8, [("1", "t", millis("2018-03-28 15:09:59"), 1)])
    assert seconds_of(ops.duration_total(frame, AS_OF), "t") == {"20180328150": 1}


def test_seconds_lose_less_than_a_second_per_bucket(spark):
    data = []
    for i in range(40):
        start = 1704067200000 + i * 777_777
        data += [(str(i), str(i), start, 1), (str(i), str(i), start + i * i * 12_345, 0)]
    split = ops.seconds_by_bucket(ops.pair_sessions(records(spark, data)), F.col("start_ms"), F.col("end_ms"))
    sums = {
        r.terminal_id: r
        for r in split.groupBy("terminal_id").agg(F.sum("duration_seconds").alias("s"), F.count("*").alias("n")).collect()
    }
    for i in range(40):
        whole = i * i * 12_345 / 1000
        assert whole - sums[str(i)].n <= sums[str(i)].s <= whole


def test_random_sessions_against_a_plain_loop(spark):
    source = random.Random(5)
    as_of, base = datetime(2024, 1, 3, 12, 34, 56), 1704067200000
    last = base + 2 * 86_400_000 + 12 * 3_600_000 + 30 * 60_000  # the bucket of as_of: 12:30
    data, expected = [], Counter()
    for i in range(400):
        terminal, start = f"t{source.randrange(9)}", base + source.randrange(2 * 86_400_000)
        data.append((str(i), terminal, start, 1))
        if source.random() < 0.8:
            end, final = start + source.choice([0, source.randrange(600_000), source.randrange(40_000_000)]), None
            data.append((str(i), terminal, end, 0))
            final = end - end % 600_000
        else:
            end, final = last + 600_000, last
        bucket = start - start % 600_000
        while bucket <= final:
            expected[terminal, bucket] += (min(end, bucket + 600_000) - max(start, bucket)) // 1000
            bucket += 600_000
    source.shuffle(data)
    got = ops.duration_total(records(spark, data), as_of)
    found = {(r.terminal_id, r.time_id): r.duration_seconds for r in got.collect()}
    key = lambda ms: datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y%m%d%H%M")[:11]
    assert found == {(t, key(b)): s for (t, b), s in expected.items()}


def test_repeated_copies_of_one_record_stay_small(spark):
    hot = spark.range(20_000).selectExpr("'1' AS serial_num", "'t' AS terminal_id", "timestamp_millis(1704067200000 + id % 2) AS ts", "cast(id % 2 as int) AS online_status")
    assert rows(ops.pair_sessions(hot)) == [("1", "t", 1704067200000, 1704067200001, 20_000)]
    assert ops.pair_by_join(hot).count() == 1


CONNECT, CLOSE = ("1", "t", 1522170909000, 1), ("1", "t", 1522170969000, 0)


@pytest.mark.parametrize(
    "data, pairs, single",
    [
        ([CONNECT, CONNECT], [], [("1", "t", 1)]),
        ([CLOSE, CLOSE, CLOSE], [], [("1", "t", 0)]),
        ([CONNECT, CLOSE, CONNECT], [("1", "t", 1522170909000, 1522170969000)], []),
        ([CLOSE, CONNECT, CLOSE, CONNECT], [("1", "t", 1522170909000, 1522170969000)], []),
        ([("1", "t", 1522170909000, 0), ("1", "t", 1522170969000, 1)], [("1", "t", 1522170909000, 1522170969000)], []),
        ([("1", "t", 1522170909000, 7), ("1", "t", None, 1)], [], []),
    ],
    ids=["copied connect", "copied close", "copy after the close", "copies of both", "close before connect", "no record"],
)
def test_pairing_goes_by_status(spark, data, pairs, single):
    frame = records(spark, data)
    assert rows(ops.pair_sessions(frame).drop("record_count")) == pairs
    assert rows(ops.pair_by_join(frame)) == pairs
    assert rows(ops.unpaired_sessions(frame).select("serial_num", "terminal_id", "online_status")) == single
    assert ops.requeue_lines(frame).count() == len(single)


def test_a_session_of_years_makes_three_rows_before_the_sum(spark):
    long = records(spark, [("1", "t", 1, 1), ("1", "t", 4_000_000_000_000, 0)])
    plan = ops.duration_total(long, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sequence(") == 1 and plan.index("sequence(") < plan.index("Window")
    short = records(spark, [("1", "t", 1522170909000, 1), ("1", "t", 1522170909000 + 400 * 86_400_000, 0)])
    total = ops.duration_total(short, AS_OF).agg(F.sum("duration_seconds"), F.count("*")).first()
    assert tuple(total) == (400 * 86_400, 400 * 144 + 1)
