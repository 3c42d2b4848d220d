"""Input and output columns. Ids are BIGINT; in stored rows lists of ids or words are comma-separated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.functions import STEP_BUCKETS, VISIT_BUCKETS, format_time, join_csv


def columns(text: str) -> T.StructType:
    """`name type, name type`, without needing a session as a DDL string would."""
    schema = T.StructType()
    for column in text.split(","):
        schema = schema.add(*column.split())
    return schema


# inputs
ACTIONS = columns(
    "session_date string, user_id long, session_id string, page_id long, action_time timestamp,"
    " search_keyword string, click_category_id long, click_product_id long, order_category_ids string,"
    " order_product_ids string, pay_category_ids string, pay_product_ids string, city_id long"
)
USERS = columns(
    "user_id long, username string, name string, age integer, professional string, city string, sex string"
)
PRODUCTS = columns("product_id long, product_name string, extend_info string")
CITIES = columns("city_id long, city_name string, area string")
AD_LOG_REJECTS = columns("value string")
AD_STREAM_PROGRESS = columns("lines long, rejects long, late long")
CLICKS = columns("ts timestamp, province string, city string, user_id long, ad_id long")

# outputs
SESSION_AGGR_STAT = columns(
    "task_id long, session_count long, "
    + ", ".join(f"visit_length_{b[0]}_ratio double" for b in VISIT_BUCKETS)
    + ", "
    + ", ".join(f"step_length_{b[0]}_ratio double" for b in STEP_BUCKETS)
)
SESSION_RANDOM_EXTRACT = columns(
    "task_id long, session_id string, start_time string, search_keywords string, click_category_ids string"
)
SESSION_DETAIL = columns(
    "task_id long, user_id long, session_id string, page_id long, action_time string,"
    " search_keyword string, click_category_id long, click_product_id long, order_category_ids string,"
    " order_product_ids string, pay_category_ids string, pay_product_ids string"
)
TOP10_CATEGORY = columns(
    "task_id long, category_id long, click_count long, order_count long, pay_count long"
)
TOP10_CATEGORY_SESSION = columns(
    "task_id long, category_id long, session_id string, click_count long"
)
PAGE_SPLIT_CONVERT_RATE = columns("task_id long, convert_rate string")
AREA_TOP3_PRODUCT = columns(
    "task_id long, area string, area_level string, product_id long, city_infos string,"
    " click_count long, product_name string, product_status string"
)
AD_USER_CLICK_COUNT = columns("date string, user_id long, ad_id long, click_count long")
AD_BLACKLIST = columns("user_id long")
AD_STAT = columns("date string, province string, city string, ad_id long, click_count long")
AD_PROVINCE_TOP3 = columns("date string, province string, ad_id long, click_count long")
AD_CLICK_TREND = columns("date string, hour string, minute string, ad_id long, click_count long")


def _stored(df: DataFrame, field: T.StructField) -> Column:
    have, want = df.schema[field.name].dataType, field.dataType
    column = F.col(field.name)
    if isinstance(have, T.ArrayType) and isinstance(want, T.StringType):
        return join_csv(column)
    if isinstance(have, T.TimestampType) and isinstance(want, T.StringType):
        return format_time(column)
    return column if have == want else column.cast(want)


def to_stored(df: DataFrame, schema: T.StructType, task_id: int | None = None) -> DataFrame:
    """The columns of `schema` in order: lists joined, times as text, the task id added."""
    stored = [
        F.lit(task_id).cast("long").alias("task_id")
        if field.name == "task_id"
        else _stored(df, field).alias(field.name)
        for field in schema.fields
    ]
    return df.select(*stored)
