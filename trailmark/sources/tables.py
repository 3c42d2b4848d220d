from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions import as_timestamp
from trailmark.params import TaskParams


def read_table(spark: SparkSession, name: str, paths: Mapping[str, str] | None = None) -> DataFrame:
    """A table by its parquet path if one is given, otherwise by name from the session's catalog."""
    if paths and name in paths:
        return spark.read.parquet(paths[name])
    return spark.table(name)


def typed_actions(actions: DataFrame) -> DataFrame:
    """`action_time` as TIMESTAMP, from text (hours with or without leading zero) or a time type."""
    return actions.withColumn("action_time", as_timestamp(actions, "action_time"))


def actions_between(actions: DataFrame, start: str, end: str) -> DataFrame:
    """The action log of an inclusive date range.

    The stored `session_date` itself is compared, so the filter reaches the scan and prunes partitions.
    """
    return typed_actions(actions.where(F.col("session_date").between(start, end)))


def save_actions(actions: DataFrame, name: str, path: str | None = None) -> None:
    """Adds actions to a table of the session's catalogue (or of the Hive metastore) that is stored by `session_date`,
    the large dates cut up by adaptive execution. A path makes the table external."""
    writer = actions.hint("rebalance", "session_date").write.mode("append").partitionBy("session_date")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def actions_on(actions: DataFrame, dates: DataFrame) -> DataFrame:
    """The action log of the dates (`session_date`) in another table, say the days of a task or a calendar.

    Of a log stored by date, only the folders of these dates are opened: they are known when the scan starts.
    """
    return typed_actions(actions.join(dates.select("session_date").distinct(), "session_date", "left_semi"))


def task_actions(actions: DataFrame, params: TaskParams) -> DataFrame:
    params.need("start_date", "end_date")
    return actions_between(actions, params.start_date, params.end_date)


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table over JDBC. For a large one pass partitionColumn, lowerBound, upperBound and numPartitions."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def jdbc_cities(spark: SparkSession, url: str, table: str = "city_info", **options: str) -> DataFrame:
    """The city table by position: id (any number type), name, area."""
    df = jdbc_table(spark, url, table, **options)
    number, name, area = df.columns[:3]
    return df.select(
        F.col(number).cast("long").alias("city_id"), F.col(name).alias("city_name"), F.col(area).alias("area")
    )


def kafka_options(brokers: str, topics: Sequence[str] | str, **more: str) -> dict[str, str]:
    names = topics.split(",") if isinstance(topics, str) else topics
    subscribe = ",".join(t.strip() for t in names if t.strip())
    return {"kafka.bootstrap.servers": brokers, "subscribe": subscribe, **more}


def kafka_lines(spark: SparkSession, brokers: str, topics: Sequence[str] | str, **more: str) -> DataFrame:
    """Stream of message texts in column `value`; keys are ignored."""
    options = kafka_options(brokers, topics, **more)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of text lines in column `value` from the files put into a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)
