"""Number helpers with rounding that is the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole_div(a: Column, b: Column | int) -> Column:
    """Integer division, truncated."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def ratio_half_up(a: Column, b: Column) -> Column:
    """smaller / larger of two non-negative whole numbers, two decimals, ties up.

    Done on integers: hundredths = floor((200*lo + hi) / (2*hi)), so no binary fraction is
    ever rounded.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    return whole_div(low * 200 + high, high * 2) / F.lit(100.0)


def format_double(value: Column, scale: int) -> Column:
    """Round half up to ``scale`` decimals, judged on the number as it is written."""
    return F.round(value, scale)


def add_text_numbers(a: Column, b: Column) -> Column:
    return a.try_cast("bigint") + b.try_cast("bigint")


def bigger_text_number(a: Column, b: Column) -> Column:
    """The text whose number is larger; the first on a tie."""
    return F.when(a.try_cast("bigint") >= b.try_cast("bigint"), a).otherwise(b)


def smaller_text_number(a: Column, b: Column) -> Column:
    """The text whose number is smaller; the second on a tie."""
    return F.when(a.try_cast("bigint") >= b.try_cast("bigint"), b).otherwise(a)


def signed_long_of_hex(hex16: Column) -> Column:
    """Eight big-endian bytes written as 16 hex digits, read as a signed 64-bit number."""
    unsigned = F.conv(hex16, 16, 10).cast("decimal(20,0)")
    fold = F.expr("CAST('18446744073709551616' AS DECIMAL(20,0))")
    largest = F.expr("CAST('9223372036854775807' AS DECIMAL(20,0))")
    return F.when(unsigned > largest, unsigned - fold).otherwise(unsigned).cast("bigint")
