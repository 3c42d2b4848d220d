"""Sessions: one row per session with the user's attributes, filters, histogram, details, hourly share.

Input `actions` has the typed columns of `schemas.ACTIONS`; `users` those of `schemas.USERS`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions import (
    STEP_BUCKETS,
    VISIT_BUCKETS,
    format_date,
    in_bucket,
    is_blank,
    pad2,
    ratio,
    seconds_between,
)
from trailmark.operators.filters import all_of, session_condition, user_condition
from trailmark.operators.metrics import Metrics, inner_join
from trailmark.params import TaskParams

ATTRIBUTES = ("age", "professional", "city", "sex")


def _word() -> Column:
    return F.when(~is_blank(F.col("search_keyword")), F.col("search_keyword"))


def session_summary(
    actions: DataFrame, users: DataFrame, params: TaskParams | None = None, metrics: Metrics | None = None
) -> DataFrame:
    """Start, length in seconds and in actions of each session with its user's attributes, and with `params` only the
    sessions that pass them. Same rows as `filter_sessions` of `session_aggregate`, without the lists.

    Whether a session has one of the words or categories asked for is one boolean each, worked out while its rows are
    combined, so that a session takes one small row however many different words it has. Sessions of unknown users are
    left out, and counted as `unmatched_sessions` if `metrics` is given.
    """
    asked = []
    if params and params.keywords is not None:
        asked.append(F.coalesce(_word().isin(list(params.keywords)), F.lit(False)))
    if params and params.category_ids is not None:
        categories = [int(c) for c in params.category_ids]
        asked.append(F.coalesce(F.col("click_category_id").isin(categories), F.lit(False)))
    sessions = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        *[F.bool_or(c).alias(f"_asked_{i}") for i, c in enumerate(asked)],
    )
    attributes = users.select("user_id", *ATTRIBUTES)
    if metrics is None:  # what fails already need not meet the users
        sessions = _where(sessions, *[F.col(f"_asked_{i}") for i in range(len(asked))])
    joined = inner_join(sessions, attributes, "user_id", metrics, "unmatched_sessions")
    passed = [F.col(f"_asked_{i}") for i in range(len(asked))] if metrics is not None else []
    return _where(joined, *passed, user_condition(params) if params else None).select(
        "session_id",
        "user_id",
        "start_time",
        seconds_between(F.col("start_time"), F.col("end_time")).alias("visit_length"),
        "step_length",
        *ATTRIBUTES,
    )


def _where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    condition = all_of(*conditions)
    return df if condition is None else df.where(condition)


def session_values(actions: DataFrame) -> DataFrame:
    """session_id, kind (`keyword` or `category`), value: the distinct search words and clicked categories of each
    session as rows, which has no limit on how many a session has. Categories are written as text."""
    values = F.array(
        F.struct(F.lit("keyword").alias("kind"), _word().alias("value")),
        F.struct(F.lit("category").alias("kind"), F.col("click_category_id").cast("string").alias("value")),
    )
    return actions.select("session_id", F.inline(values)).where("value is not null").distinct()


def with_lists(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """Adds search_keywords and click_category_ids, ascending, to a few sessions, which should be a stored table."""
    lists = (
        session_details(actions, sessions)
        .groupBy("session_id")
        .agg(
            F.array_sort(F.collect_set(_word())).alias("search_keywords"),
            F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        )
    )
    return sessions.join(lists, "session_id")


def session_aggregate(actions: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct search words and clicked categories (ascending), start, length in seconds and in actions of
    each session, with its user's attributes. Sessions of unknown users are left out.

    One shuffle by session of rows combined on the map side, so that a session with very many actions arrives
    as one row per map task; then the join with the users. Lists nobody reads are not built. A list is one cell:
    where a session may have any number of words, use `session_summary` and `session_values`.
    """
    sessions = (
        actions.groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.array_sort(F.collect_set(_word())).alias("search_keywords"),
            F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
            F.min("action_time").alias("start_time"),
            F.max("action_time").alias("end_time"),
            F.count(F.lit(1)).alias("step_length"),
        )
        .withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))
    )
    attributes = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(attributes, "user_id").select(
        "session_id",
        "user_id",
        "search_keywords",
        "click_category_ids",
        "start_time",
        "visit_length",
        "step_length",
        "age",
        "professional",
        "city",
        "sex",
    )


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    condition = session_condition(params)
    return sessions if condition is None else sessions.where(condition)


def session_stats(sessions: DataFrame) -> DataFrame:
    """One row: the number of sessions and the share of each length and step bucket, two decimals.

    Sessions of 0 seconds are in no length bucket, so the shares need not add up to 1.
    """
    buckets = [(f"visit_length_{name}", "visit_length", lo, hi) for name, lo, hi in VISIT_BUCKETS]
    buckets += [(f"step_length_{name}", "step_length", lo, hi) for name, lo, hi in STEP_BUCKETS]
    counts = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[F.count_if(in_bucket(F.col(c), lo, hi)).alias(name) for name, c, lo, hi in buckets],
    )
    return counts.select(
        "session_count",
        *[ratio(F.col(name), F.col("session_count")).alias(f"{name}_ratio") for name, *_ in buckets],
    )


def session_details(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The actions of the given sessions.

    `sessions` should be a stored table, so that its size is known: small, it is broadcast. Otherwise both
    sides are shuffled as they are read, which lets adaptive execution cut up a session with very many actions.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """date, hour (two digits) and session_count; written as text after counting."""
    counts = sessions.groupBy(
        F.to_date("start_time").alias("day"), F.hour("start_time").alias("hour_of_day")
    ).agg(F.count(F.lit(1)).alias("session_count"))
    return counts.select(
        format_date(F.col("day")).alias("date"), pad2(F.col("hour_of_day")).alias("hour"), "session_count"
    )


def session_hour_share(sessions: DataFrame) -> DataFrame:
    """Sessions per hour and their share of all sessions. The total runs over the hourly rows only."""
    total = F.sum("session_count").over(Window.partitionBy())
    return sessions_per_hour(sessions).withColumn("share", F.col("session_count") / total)


def unmatched(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """How many rows an inner join on `key` drops because the dimension has no such key."""
    left = df.join(dimension.select(key), key, "left_anti")
    return left.agg(F.count(F.lit(1)).alias("unmatched"))
