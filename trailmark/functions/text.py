from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.length(c) == 0)


def csv_strings(c: Column) -> Column:
    """Comma-separated text as an array of its non-blank parts; NULL stays NULL."""
    parts = F.transform(F.split(c, ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: F.length(x) > 0)


def csv_longs(c: Column) -> Column:
    """Comma-separated ids as array<bigint>; parts that are no number are left out."""
    ids = F.transform(F.split(c, ","), lambda x: F.trim(x).try_cast("bigint"))
    return F.filter(ids, lambda x: x.isNotNull())


def join_csv(c: Column) -> Column:
    return F.array_join(c, ",")


def trim_comma(c: Column) -> Column:
    """Takes off one leading and one trailing comma."""
    return F.regexp_replace(c, "^,|,$", "")


def concat_long_string(number: Column, text: Column, sep: str = ":") -> Column:
    return F.concat_ws(sep, number.cast("string"), text)


def group_concat_distinct(c: Column, sep: str = ",") -> Column:
    """Aggregate: the distinct non-null texts of a group, ascending, joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def json_field(c: Column, name: str) -> Column:
    """Top-level field of a JSON object as text; NULL for a missing field or broken JSON."""
    return F.get_json_object(c, f"$['{name}']")


def pad2(c: Column) -> Column:
    """Two digits with a leading zero; longer numbers stay whole."""
    text = c.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)
