"""The package's input tables derived from general star-schema and event tables.

Row by row, without shuffles: `events` becomes the action log and the ad log, `customer` the users, `part`
the products, `nation` and `region` the cities. k is the number in the JSON column `props`, 0 to 99.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions import json_field
from trailmark.schemas import columns

EVENTS = columns(
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)
N_CITIES = 25


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events")


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    # a pattern, as a stream takes no single file as its path; it reads one file as well as a folder of them
    return spark.readStream.schema(EVENTS).parquet(f"{folder}/event[s].parquet")


def _k() -> Column:
    return json_field(F.col("props"), "k").cast("bigint")


def user_visit_action(spark: SparkSession, folder: str) -> DataFrame:
    def on(event_type: str, value: Column) -> Column:
        return F.when(F.col("event_type") == event_type, value)

    def pair(step: int, base: int) -> Column:
        return F.concat_ws(",", F.col("k") % base, (F.col("k") + step) % base)

    rows = events(spark, folder).select(
        "event_id",
        "user_id",
        "event_type",
        _k().alias("k"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("action_time"),
        F.date_format("ts", "yyyy-MM-dd").alias("session_date"),
    )
    return rows.select(
        "session_date",
        "user_id",
        F.concat_ws("_", "user_id", "session_date").alias("session_id"),
        (F.col("k") % 10).alias("page_id"),
        "action_time",
        on("view", F.concat(F.lit("kw"), F.col("k") % 10)).alias("search_keyword"),
        on("click", F.col("k") % 20).alias("click_category_id"),
        on("click", F.col("k")).alias("click_product_id"),
        on("signup", pair(7, 20)).alias("order_category_ids"),
        on("signup", pair(7, 100)).alias("order_product_ids"),
        on("purchase", (F.col("k") % 20).cast("string")).alias("pay_category_ids"),
        on("purchase", F.col("k").cast("string")).alias("pay_product_ids"),
        (F.col("user_id") % N_CITIES).alias("city_id"),
        "event_id",
    )


def user_info(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("user"), F.col("c_custkey")).alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey")).alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def product_info(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), F.col("p_size") % 2, F.lit("}")).alias("extend_info"),
    )


def city_info(spark: SparkSession, folder: str) -> DataFrame:
    nations, regions = _table(spark, folder, "nation"), _table(spark, folder, "region")
    joined = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"])
    return joined.select(
        F.col("n_nationkey").cast("long").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def ad_log_lines(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Event rows, stored or streamed, as ad log lines in column `value`."""
    # millis and ad are worked out below the join, once per row
    clicks = rows.select(
        "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"), (_k() % 10).alias("ad_id")
    )
    located = clicks.join(city_info(spark, folder), F.col("user_id") % N_CITIES == F.col("city_id"))
    line = F.concat_ws(
        " ", "millis", F.translate("area", " ", "-"), F.translate("city_name", " ", "-"), "user_id", "ad_id"
    )
    return located.select(line.alias("value"))
