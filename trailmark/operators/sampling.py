"""Stratified sample of sessions: a day's quota is spread over its hours by their number of sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions import int_div
from trailmark.operators.sessions import session_details
from trailmark.operators.skew import broadcast_bounded

# sessions of an hour are cut into 16**3 slices by the first digits of their draw
SLICE_DIGITS = 3


def _with_draw(sessions: DataFrame, seed: str) -> DataFrame:
    draw = F.coalesce(F.md5(F.concat(F.lit(seed), F.col("session_id"))), F.lit(""))
    keyed = sessions.where("session_id is not null and start_time is not null").select(
        "session_id",
        F.to_date("start_time").alias("_date"),
        F.hour("start_time").alias("_hour"),
        draw.alias("_draw"),
        F.substring(draw, 1, SLICE_DIGITS).alias("_slice"),
    )
    # said here rather than left to the joins, so that all uses of the counts share one shuffle
    return keyed.where("_date is not null and _hour is not null")


def _quota(total: int) -> Column:
    """Sessions to take from an hour: its part of the day's quota, never more than it has."""
    per_day = int_div(F.lit(total).cast("long"), F.col("_days"))
    return F.least(int_div(F.col("_in_hour") * per_day, F.col("_in_day")), F.col("_in_hour"))


def hour_quotas(hours: DataFrame, total: int = 100) -> DataFrame:
    """Adds `quota` to rows of (_date, _hour, _in_hour): total div days per day, then by share of the hour.

    There is one row per hour of the date range, few enough for one task to count the days.
    """
    days = F.size(F.collect_set("_date").over(Window.partitionBy())).cast("long")
    in_day = F.sum("_in_hour").over(Window.partitionBy("_date"))
    counted = hours.withColumn("_days", days).withColumn("_in_day", in_day)
    return counted.withColumn("quota", _quota(total))


def sample_sessions(sessions: DataFrame, total: int = 100, seed: str = "") -> DataFrame:
    """About `total` sessions, drawn without replacement and repeatable for the same seed.

    Within an hour the sessions with the smallest md5(seed || session_id) are taken. No hour is ever sorted
    as a whole: counts per (hour, slice of the draw) tell which slices are taken completely and in which one
    the quota ends, and only candidates of one slice are ranked together. Drawing needs the start times only;
    the other columns are fetched for the sampled sessions. Lists are passed on if `sessions` has them; otherwise
    `sessions.with_lists` adds those of the sample.
    """
    keyed = _with_draw(sessions, seed)
    slices = keyed.groupBy("_date", "_hour", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    hours = slices.groupBy("_date", "_hour").agg(F.sum("_n").alias("_in_hour"))
    quotas = hour_quotas(hours, total).where("quota > 0").select("_date", "_hour", "quota")

    # the quotas add up to at most `total`, so there are at most that many hours
    running = F.sum("_n").over(
        Window.partitionBy("_date", "_hour").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    )
    ends = (
        slices.join(broadcast_bounded(quotas, total), ["_date", "_hour"])
        .withColumn("_before", running - F.col("_n"))
        .where("_before < quota and quota <= _before + _n")
        .withColumn("_rest", F.col("quota") - F.col("_before"))
        .select("_date", "_hour", F.col("_slice").alias("_last"), "_rest")
    )
    candidates = keyed.join(broadcast_bounded(ends, total), ["_date", "_hour"]).where("_slice <= _last")
    rank = F.row_number().over(
        Window.partitionBy("_date", "_hour", "_slice").orderBy("_draw", "session_id")
    )
    chosen = candidates.withColumn("_rank", rank).where("_slice < _last or _rank <= _rest")
    picked = broadcast_bounded(chosen.select("session_id"), total)
    lists = [c for c in ("search_keywords", "click_category_ids") if c in sessions.columns]
    rows = sessions.select("session_id", "start_time", *lists)
    return rows.join(picked, "session_id", "left_semi")


def sample_details(sample: DataFrame, details: DataFrame) -> DataFrame:
    """The actions of the sampled sessions; `sample` should be a stored table."""
    return session_details(details, sample)
