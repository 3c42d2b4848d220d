"""Column helpers: plain built-in expressions, no UDFs."""

from trailmark.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS, in_bucket
from trailmark.functions.labels import AREA_LEVELS, area_level, product_status
from trailmark.functions.numbers import int_div, ratio
from trailmark.functions.text import (
    concat_long_string,
    csv_longs,
    csv_strings,
    group_concat_distinct,
    is_blank,
    join_csv,
    json_field,
    pad2,
    trim_comma,
)
from trailmark.functions.times import (
    as_timestamp,
    date_key,
    format_date,
    format_time,
    hour_key,
    minute_key,
    parse_date_key,
    parse_time,
    seconds_between,
    today,
    yesterday,
)

__all__ = [
    "AREA_LEVELS",
    "STEP_BUCKETS",
    "VISIT_BUCKETS",
    "area_level",
    "as_timestamp",
    "concat_long_string",
    "csv_longs",
    "csv_strings",
    "date_key",
    "format_date",
    "format_time",
    "group_concat_distinct",
    "hour_key",
    "in_bucket",
    "int_div",
    "is_blank",
    "join_csv",
    "json_field",
    "minute_key",
    "pad2",
    "parse_date_key",
    "parse_time",
    "product_status",
    "ratio",
    "seconds_between",
    "today",
    "trim_comma",
    "yesterday",
]
