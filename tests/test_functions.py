"""Column functions against plain-Python rules on many small texts."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from telemetra.functions import numbers, text, timekeys


def split_drop_empty(s, sep):
    """Split, dropping empty items at the end; a text without separator is one item."""
    parts = s.split(sep)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def get_rule(s, field):
    for item in split_drop_empty(s, "|"):
        pair = split_drop_empty(item, "=")
        if len(pair) == 2 and pair[0] == field:
            return pair[1]
    return None


def set_rule(s, field, value):
    items = split_drop_empty(s, "|")
    for i, item in enumerate(items):
        if item.split("=")[0] == field:
            items[i] = f"{field}={value}"
            break
    return "|".join(items)


@pytest.fixture(scope="module")
def texts():
    source = random.Random(11)
    made = {"".join(source.choice(["a", "b", "ab", "=", "=", "|", "|", ",", "$", "1"]) for _ in range(source.randint(0, 14))) for _ in range(3000)}
    return sorted(made) + ["a=1|a=2", "b=|a=1", "a=1=|b=2", "a=\n1|b=x", "a", "|a=1", "a=1||"]


def test_kv_get_and_set(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "s string")
    got = frame.select(
        "s", text.kv_get(F.col("s"), "a").alias("a"), text.kv_get(F.col("s"), "ab").alias("ab"),
        text.kv_set(F.col("s"), "a", "n$1\\x").alias("set_a"), text.kv_set(F.col("s"), "b", F.lit("7")).alias("set_b"),
    ).collect()
    for r in got:
        assert (r.s, r.a) == (r.s, get_rule(r.s, "a"))
        assert (r.s, r.ab) == (r.s, get_rule(r.s, "ab"))
        assert (r.s, r.set_a) == (r.s, set_rule(r.s, "a", "n$1\\x"))
        assert (r.s, r.set_b) == (r.s, set_rule(r.s, "b", "7"))


def test_kv_get_with_another_delimiter(spark):
    frame = spark.createDataFrame([("a=1;b=2|3;c",)], "s string")
    row = frame.select(text.kv_get(F.col("s"), "b", ";").alias("b"), text.kv_set(F.col("s"), "c", "9", ";").alias("c")).first()
    assert (row.b, row.c) == ("2|3", "a=1|b=2|3|c=9")


@pytest.mark.parametrize(
    "data, param, between, member, equal",
    [
        ("age=30|p=x,y|c=q", "lo=30|hi=40|p=y,z|c=q", True, True, True),
        ("age=41|p=x|c=q", "lo=30|hi=40|p=y,z|c=r", False, False, False),
        ("age=41", "lo=30", True, True, True),
        ("p=1", "lo=1|hi=2|p=2|c=q", False, False, False),
        ("age=|c=", "lo=1|hi=2|p=2|c=q", False, False, False),
        ("age=x", "lo=1|hi=2", False, True, True),
    ],
)
def test_kv_predicates(spark, data, param, between, member, equal):
    frame = spark.createDataFrame([(data, param)], "d string, p string")
    d, p = F.col("d"), F.col("p")
    row = frame.select(
        text.kv_between(d, "age", p, "lo", "hi"), text.kv_in(d, "p", p, "p"), text.kv_equal(d, "c", p, "c")
    ).first()
    assert tuple(row) == (between, member, equal)


def test_text_helpers(spark):
    frame = spark.createDataFrame([(",a,b,",), (",",), ("",), ("7",), ("07",), ("12.5km",), ("km12.5",), (None,)], "s string")
    s = F.col("s")
    got = frame.select(
        "s", text.trim_comma(s), text.pad_two_digits(s), text.cut_at_dot(s, "km"), text.is_nil(s), text.is_empty(s), text.is_not_empty(s)
    ).collect()
    assert [tuple(r) for r in got] == [
        (",a,b,", "a,b", "0,a,b,", ",a,b,", False, False, True),
        (",", "", "0,", ",", False, False, True),
        ("", "", "0", "", True, True, False),
        ("7", "7", "07", "7", False, False, True),
        ("07", "07", "07", "07", False, False, True),
        ("12.5km", "12.5km", "012.5km", "12", False, False, True),
        ("km12.5", "km12.5", "0km12.5", "km12.5", False, False, True),
        (None, None, None, None, True, True, False),
    ]


def test_ratio_is_the_exact_half_up_hundredth(spark):
    pairs = [(a, b) for b in (1, 2, 3, 7, 8, 40, 120, 200, 600) for a in range(0, b + 1, max(1, b // 40))] + [(171, 600), (600, 171)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    for r in frame.select("a", "b", numbers.ratio_half_up(F.col("a"), F.col("b")).alias("x")).collect():
        low, high = min(r.a, r.b), max(r.a, r.b)
        assert r.x == float((Decimal(200 * low + high) // Decimal(2 * high)) / 100), (r.a, r.b)


def test_format_double(spark):
    frame = spark.createDataFrame([(1.005,), (2.675,), (-0.125,), (3.0,)], "v double")
    got = [r[0] for r in frame.select(numbers.format_double(F.col("v"), 2)).collect()]
    assert got == [float(Decimal(s).quantize(Decimal("0.01"), ROUND_HALF_UP)) for s in ("1.005", "2.675", "-0.125", "3.0")]


def test_number_texts(spark):
    frame = spark.createDataFrame([("9", "10"), ("07", "7"), ("-1", "-2")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = frame.select(numbers.bigger_text_number(a, b), numbers.smaller_text_number(a, b), numbers.add_text_numbers(a, b)).collect()
    assert [tuple(r) for r in got] == [("10", "9", 19), ("07", "7", 14), ("-1", "-2", -3)]


def test_hex_and_long(spark):
    frame = spark.createDataFrame([(n,) for n in (0, 1, -1, 2**63 - 1, -(2**63), 258)], "n long")
    got = frame.select("n", numbers.signed_long_of_hex(F.lpad(F.hex("n"), 16, "0")).alias("back")).collect()
    assert all(r.n == r.back for r in got)
    row = spark.createDataFrame([("abc",)], "s string").select(text.md5_upper(F.col("s")), text.bytes_to_hex(F.col("s").cast("binary"))).first()
    assert tuple(row) == ("900150983CD24FB0D6963F7D28E17F72", "616263")


def test_json_array_first(spark):
    frame = spark.createDataFrame([('{"f":["a","b"]}',), ('{"f":[]}',), ('{"g":1}',), ('{"f":[7]}',)], "j string")
    assert [r[0] for r in frame.select(text.first_of_json_array(F.col("j"), "f")).collect()] == ["a", None, None, "7"]


def test_time_keys_follow_the_session_zone(spark_utc8):
    frame = spark_utc8.createDataFrame([(1519660981609,)], "ms long")
    ts = F.timestamp_millis("ms")
    row = frame.select(
        timekeys.time_id_of_millis(F.col("ms")), timekeys.time_id_of_seconds(F.floor(F.col("ms") / 1000)),
        timekeys.bucket_start_ms(F.col("ms")), timekeys.bucket_end_ms(F.col("ms")),
        timekeys.previous_hour_key(ts), timekeys.previous_day_key(ts),
    ).first()
    assert tuple(row) == ("20180227000", "20180227000", 1519660800000, 1519661400000, "2018022623", "20180226")


def test_time_compare_with_bad_text(spark):
    frame = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:01:00"), ("bad", "2024-01-01 00:01:00"), (None, None)], "a string, b string"
    )
    a, b = F.col("a"), F.col("b")
    got = frame.select(timekeys.is_before(a, b), timekeys.is_after(a, b), timekeys.minus_seconds(a, b)).collect()
    assert [tuple(r) for r in got] == [(True, False, -60), (False, False, 0), (False, False, 0)]


def test_calendar(spark):
    frame = spark.createDataFrame([("2024-12-29 23:59:59",)], "t string")  # a Sunday
    ts = F.col("t").cast("timestamp")
    units = ["minute", "hour", "day", "week", "month"]
    row = frame.select(
        *[timekeys.next_start_of(u, ts).cast("string") for u in units], timekeys.start_of("week", ts).cast("string"), timekeys.date_hour(F.col("t"))
    ).first()
    assert tuple(row) == (
        "2024-12-30 00:00:00", "2024-12-30 00:00:00", "2024-12-30 00:00:00", "2024-12-30 00:00:00", "2025-01-01 00:00:00",
        "2024-12-23 00:00:00", "2024-12-29_23",
    )
