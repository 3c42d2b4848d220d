from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed formats of the data model
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_INPUT_FORMAT = "yyyy-MM-dd H:mm:ss"  # hours may come without the leading zero
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
HOUR_KEY_FORMAT = "yyyy-MM-dd_HH"


def parse_time(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(TIME_INPUT_FORMAT))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """A time column as TIMESTAMP, whether it is stored as text, as TIMESTAMP_NTZ or already typed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_time(F.col(name))
    return F.col(name).cast("timestamp")


def format_time(c: Column) -> Column:
    return F.date_format(c, TIME_FORMAT)


def format_date(c: Column) -> Column:
    return F.date_format(c, DATE_FORMAT)


def date_key(c: Column) -> Column:
    return F.date_format(c, DATE_KEY_FORMAT)


def parse_date_key(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit(DATE_KEY_FORMAT)))


def minute_key(c: Column) -> Column:
    return F.date_format(c, MINUTE_KEY_FORMAT)


def hour_key(c: Column) -> Column:
    return F.date_format(c, HOUR_KEY_FORMAT)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def today() -> Column:
    return F.current_date()


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1)
