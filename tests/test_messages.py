"""GPS envelopes and points with hand-derived results; keys in UTC+8."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from telemetra.operators import point_metrics as pm
from telemetra.sources import lines as src
from tests.conftest import as_dict, rows


def point(time, speed="0.00", satellites="-1", online="0"):
    return f"{time}, 0.000000, 0.000000,{speed},0,0,{satellites}, 0.000000,0.00,{online}"


def envelope(terminal, points, command="420"):
    body = {
        "appKey": "", "checksum": 0, "cmdId": command, "length": 1, "serialNo": 7, "terminalId": terminal,
        "message": base64.b64encode(";".join(points).encode()).decode(), "version": "4.2",
    }
    return "GW_001@@@" + json.dumps(body, separators=(",", ":"))


def lines_of(spark, texts):
    return src.clean_lines(spark.createDataFrame([(t,) for t in texts], "value string"))


TWO_ENVELOPES = [
    envelope("1116996", [point("2018-04-17 13:40:35.7", online="1")]),
    '"' + envelope("1116751", [point(f"2018-04-17 12:0{1 + i // 4}:{10 + i}.7", online="1" if i < 2 else "0") for i in range(20)]) + '"',
]


@pytest.mark.parametrize(
    "n, expected",
    [
        (600, {"1116996": (120, 8, 0.01), "1116751": (120, 8, 0.02)}),
        (15, {"1116996": (3, 0, 0.33), "1116751": (15, 1, 0.13)}),
    ],
)
def test_metrics_of_two_envelopes(spark_utc8, n, expected):
    points = src.parse_gps_lines(lines_of(spark_utc8, TWO_ENVELOPES))
    wide = as_dict(pm.metrics_wide(points, n), "terminal_id")
    assert {t[0]: (r.gps_total_num, r.gps_frequent, r.gps_online_percent) for t, r in wide.items()} == expected
    one, twenty = wide[("1116996",)], wide[("1116751",)]
    assert (one.time_id, twenty.time_id) == ("20180417134", "20180417120")
    counted = ["gps_online_total", "gps_offline_total", "gps_not_open_num", "gps_zero_speed_num", "gps_weak_num", "gps_normal_num"]
    assert [one[c] for c in counted] == [1, 0, 1, 1, 0, 0]
    assert [twenty[c] for c in counted] == [2, 18, 20, 20, 0, 0]


def test_absent_metrics_have_no_row(spark_utc8):
    points = src.parse_gps_lines(lines_of(spark_utc8, TWO_ENVELOPES))
    found = {r.metric for r in pm.metrics_long(points).where("terminal_id = '1116996'").collect()}
    assert found == {"gpsTotalNum", "gpsFrequent", "gpsOnlineTotal", "gpsNotOpenNum", "zeroSpeedNum", "gpsOnlinePercent"}


OLD_POINTS = [  # speed, satellites, online
    (4, 6, 1), (3, 6, 1), (2, 6, 1), (1, 2, 0), (0, -1, 0), (0, 2, 0), (0, -1, 0), (0, 2, 0), (0, 2, 0),
]


@pytest.mark.parametrize("n, expected", [(600, (120, 8, 0.03)), (15, (15, 1, 0.2))])
def test_points_of_one_bucket(spark_utc8, n, expected):
    at = "2018-03-29 11:1{}:05.0"
    lines = [envelope("1", [point(at.format(i), f"{s}.00", str(sat), str(on))]) for i, (s, sat, on) in enumerate(OLD_POINTS)]
    lines.append(envelope("1", [point(at.format(9), "0.00", "1", "1")], command="411"))
    (row,) = pm.metrics_wide(src.parse_gps_lines(lines_of(spark_utc8, lines)), n).collect()
    assert (row.terminal_id, row.time_id) == ("1", "20180329111")
    assert (row.gps_total_num, row.gps_frequent, row.gps_online_percent) == expected
    assert (row.gps_online_total, row.gps_offline_total, row.gps_weak_num) == (3, 6, 4)
    assert (row.gps_not_open_num, row.gps_zero_speed_num, row.gps_normal_num) == (2, 5, 3)


def test_both_time_formats_give_the_same_bucket(spark_utc8):
    lines = [envelope("9", [point("2018-03-28 01:15:09.123"), point("1522170909000"), point("1522170909")])]
    parsed = src.parse_gps_lines(lines_of(spark_utc8, lines)).select("raw_time", F.unix_millis("ts")).collect()
    assert [tuple(r) for r in parsed] == [
        ("2018-03-28 01:15:09.123", 1522170909000), ("1522170909000", 1522170909000), ("1522170909", 1522170909)
    ]


def test_first_point_only(spark_utc8):
    points = src.parse_gps_first_points(lines_of(spark_utc8, TWO_ENVELOPES))
    assert [tuple(r) for r in points.groupBy("terminal_id").count().orderBy("terminal_id").collect()] == [
        ("1116751", 1), ("1116996", 1)
    ]


def test_bad_input_is_rejected_not_fatal(spark_utc8):
    good = point("2018-04-17 13:40:35.7", online="1")
    lines = [
        'GW_001@@@{"cmdId":"420","terminalId":"1","message":',
        'GW_002@@@{"cmdId":"420","terminalId":"2","message":"%%%"}',
        envelope("3", [good, "not,a,point", point("soon")]),
        envelope("4", [good + ";;"]),
        'GW_005 "cmdId":"420" without a body',
    ]
    frame = lines_of(spark_utc8, lines)
    assert rows(src.parse_gps_lines(frame).groupBy("terminal_id").count()) == [("3", 1), ("4", 1)]
    rejected = src.gps_rejects(frame).collect()
    assert sorted(r.value[:6] for r in rejected) == ["GW_001", "GW_001", "GW_001", "GW_002", "GW_005"]
    assert {r.point for r in rejected} >= {"not,a,point", point("soon")}


def test_quotes_are_stripped_on_both_sides(spark):
    assert [r.value for r in lines_of(spark, ['"ab"', "ab", '"abc', "a\"b\"", '""', '"']).collect()] == [
        "ab", "ab", "ab", 'a"b"', "", ""
    ]


def test_log_lines(spark):
    lines = [
        "serialNum:1519659181610963,terminalId:1503420,time:1519660981609,online:0,serverIp:192.168.171.231",
        "serialNum:1,terminalId:2,time:3,online:1,serverIp:x,,",
        "serialNum:1,terminalId:2,time:3,online:1",
        "serialNum:1,terminalId:2,time:3,online:1,",
        "serialNum:1,terminalId:2,time:3,online:1,serverIp:x,extra",
        "serialNum:1,terminalId:2,time:soon,online:1,serverIp:x",
        "serialNum:,terminalId:2,time:3,online:1,serverIp:x",
        "",
    ]
    frame = spark.createDataFrame([(t,) for t in lines], "value string")
    got = src.parse_log_lines(frame).select("serial_num", "terminal_id", F.unix_millis("ts"), "online_status")
    assert rows(got) == [("1", "2", 3, 1), ("1519659181610963", "1503420", 1519660981609, 0)]
    assert src.log_rejects(frame).count() == 6


def test_log_lines_round_trip(spark):
    frame = spark.createDataFrame([("5", "7", 1522170909123, 1)], "serial_num string, terminal_id string, ms long, online_status int")
    records = frame.select("serial_num", "terminal_id", F.timestamp_millis("ms").alias("ts"), "online_status")
    lines = src.format_log_lines(records, F.lit("10.0.0.1"))
    assert lines.first().value == "serialNum:5,terminalId:7,time:1522170909123,online:1,serverIp:10.0.0.1"
    assert rows(src.parse_log_lines(lines)) == rows(records)
