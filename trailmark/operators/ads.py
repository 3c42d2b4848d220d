"""Ad clicks as plain DataFrame transforms. All of them also work on one micro-batch of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import format_date
from trailmark.operators.topn import top_n_per_group

BLACKLIST_THRESHOLD = 100
# the years 1 to 9999, which is what dates as text can hold
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def parse_fields(lines: DataFrame) -> DataFrame:
    """Lines with what their parts say in the struct `_click`, NULL where a part is missing or of another type."""
    parts = F.split("value", " ")

    def part(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i))

    millis = part(1).try_cast("bigint")
    return lines.withColumn(
        "_click",
        F.struct(
            F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), F.timestamp_millis(millis)).alias("ts"),
            part(2).alias("province"),
            part(3).alias("city"),
            part(4).try_cast("bigint").alias("user_id"),
            part(5).try_cast("bigint").alias("ad_id"),
        ),
    )


_VALID = "_click.ts is not null and _click.user_id is not null and _click.ad_id is not null"


def ad_log_valid() -> Column:
    """Whether a line of `parse_fields` is a click."""
    return F.expr(_VALID)


def parse_ad_log(lines: DataFrame) -> DataFrame:
    """Lines `millis province city userId adId` in column `value` as ts, province, city, user_id, ad_id.

    Lines without a time, user or ad are left out, see `ad_log_rejects`.
    """
    return parse_fields(lines).where(_VALID).select("_click.*")


def ad_log_rejects(lines: DataFrame) -> DataFrame:
    return parse_fields(lines).where(f"not ({_VALID})").drop("_click")


def _daily(clicks: DataFrame, *keys: str) -> DataFrame:
    """Clicks per date and keys; the date is written as text after counting."""
    counts = clicks.groupBy(F.to_date("ts").alias("date"), *keys)
    return counts.agg(F.count(F.lit(1)).alias("click_count")).withColumn("date", format_date(F.col("date")))


def user_daily_clicks(clicks: DataFrame) -> DataFrame:
    return _daily(clicks, "user_id", "ad_id")


def over_threshold(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    return counts.where(F.col("click_count") >= threshold)


def daily_blacklist(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """user_id and the first date on which the user clicked one ad `threshold` times or more.

    What the stream finds when its batches are whole days, computed in one pass over stored clicks.
    """
    flagged = over_threshold(user_daily_clicks(clicks), threshold)
    return flagged.groupBy("user_id").agg(F.min("date").alias("flagged_date"))


def clicks_until_flagged(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """The clicks of a blacklisted user up to and including the flagged date, and all others' clicks.

    `blacklist` should be a stored table, so that its size is known: small, it is broadcast. Otherwise both
    sides are shuffled as they are read, which lets adaptive execution cut up a user with very many clicks.
    """
    flags = blacklist.select("user_id", F.col("flagged_date").cast("date").alias("_flagged"))
    joined = clicks.join(flags, "user_id", "left")
    kept = F.col("_flagged").isNull() | (F.to_date("ts") <= F.col("_flagged"))
    return joined.where(kept).select(*clicks.columns)


def ad_stat(clicks: DataFrame) -> DataFrame:
    return _daily(clicks, "province", "city", "ad_id")


def province_top_ads(stat: DataFrame, n: int = 3) -> DataFrame:
    """The n ads with most clicks of each date and province; ties by ad id. `stat` as from `ad_stat`."""
    counts = stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))
    return top_n_per_group(counts, ["date", "province"], [F.col("click_count").desc(), F.col("ad_id")], n)


def minute_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(F.date_trunc("minute", "ts").alias("minute_start"), "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def last_minutes(
    rows: DataFrame, minutes: int = 60, until: Column | None = None, time: str = "ts"
) -> DataFrame:
    """The rows of the `minutes` minutes up to that of `until`, by default of the newest row; none after `until`.

    The bare time column is compared, so that files can be skipped by it.
    """
    until = rows.agg(F.max(time)).scalar() if until is None else until
    since = F.date_trunc("minute", until) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes - 1), F.lit(0))
    return rows.where((F.col(time) >= since) & (F.col(time) <= until))


def click_trend(minute_counts: DataFrame) -> DataFrame:
    """Minute counts in the columns date, hour, minute, ad_id, click_count."""
    start = F.col("minute_start")
    return minute_counts.select(
        F.date_format(start, "yyyy-MM-dd").alias("date"),
        F.date_format(start, "HH").alias("hour"),
        F.date_format(start, "mm").alias("minute"),
        "ad_id",
        "click_count",
    )
