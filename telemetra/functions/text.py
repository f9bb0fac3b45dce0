"""Text, key=value and hex helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_not_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def is_nil(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def trim_comma(text: Column) -> Column:
    """Drop at most one comma on each side."""
    return F.regexp_replace(F.regexp_replace(text, r"\A,", ""), r",\z", "")


def pad_two_digits(text: Column) -> Column:
    """A leading zero unless the text already has two characters."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def cut_at_dot(text: Column, marker: str) -> Column:
    """Cut at the first dot when ``marker`` occurs after the first character."""
    return F.when(F.instr(text, marker) > 1, F.substring_index(text, ".", 1)).otherwise(text)


def strip_quotes(line: Column) -> Column:
    """A line that starts with a double quote loses its first and last character."""
    inner = F.substr(line, F.lit(2), F.length(line) - 2)
    return F.when(F.startswith(line, F.lit('"')), inner).otherwise(line)


def md5_upper(text: Column) -> Column:
    return F.upper(F.md5(text))


def bytes_to_hex(data: Column) -> Column:
    return F.hex(data)


def java_text(value: Column) -> Column:
    """Text of a value inside a joined record; a missing one reads ``null``."""
    return F.coalesce(value.cast("string"), F.lit("null"))


def first_of_json_array(json: Column, field: str) -> Column:
    """First element of an array field, null when the array is empty or absent."""
    return F.get_json_object(json, f"$.{field}[0]")


# ---- key=value lists: "name=value|name=value" -------------------------------------------


def kv_get(text: Column, field: str, delimiter: str = "|") -> Column:
    """Value of the first ``field=value`` item with a non-empty value, else null.

    One regular expression: the item must hold exactly one value; equals signs after it are
    ignored and an item with a second value does not count.
    """
    sep = re.escape(delimiter)
    value = f"(?:(?!{sep})[^=])+"
    pattern = rf"(?:\A|{sep}){re.escape(field)}=({value})=*(?={sep}|\z)"
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def kv_set(text: Column, field: str, value: Column | str, delimiter: str = "|") -> Column:
    """Replace the first item named ``field``; nothing is appended when there is none.

    Empty items at the end are dropped, and items are joined with ``|`` again.
    """
    sep = re.escape(delimiter)
    items = F.regexp_replace(text, rf"(?:{sep})+\z", "")
    item = f"(?:(?!{sep}).)*"
    first_named = rf"(?s)\A((?:{item}{sep})*?){re.escape(field)}(?:={item})?(?={sep}|\z)"
    plain = value if isinstance(value, Column) else F.lit(value)
    escaped = F.replace(F.replace(plain, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    changed = F.regexp_replace(items, F.lit(first_named), F.concat(F.lit(f"$1{field}="), escaped))
    return changed if delimiter == "|" else F.replace(changed, F.lit(delimiter), F.lit("|"))


def kv_between(data: Column, field: str, param: Column, low: str, high: str) -> Column:
    """Whether the number in ``field`` lies in the parameter's range, ends included.

    A missing bound accepts everything; a missing field is rejected.
    """
    number = kv_get(data, field).try_cast("int")
    low_text, high_text = kv_get(param, low), kv_get(param, high)
    inside = number.between(low_text.try_cast("int"), high_text.try_cast("int"))
    return low_text.isNull() | high_text.isNull() | F.coalesce(inside, F.lit(False))


def kv_in(data: Column, field: str, param: Column, param_field: str) -> Column:
    """Whether a comma item of the field equals a comma item of the parameter."""
    wanted = kv_get(param, param_field)
    shared = F.arrays_overlap(F.split(kv_get(data, field), ","), F.split(wanted, ","))
    return wanted.isNull() | F.coalesce(shared, F.lit(False))


def kv_equal(data: Column, field: str, param: Column, param_field: str) -> Column:
    wanted = kv_get(param, param_field)
    return wanted.isNull() | F.coalesce(kv_get(data, field) == wanted, F.lit(False))
