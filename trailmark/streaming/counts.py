"""Running counts: per day, province, city and ad, with the top ads of each province; and per minute and ad.

Each micro-batch adds its own counts to tables that are summed on reading. There is no state and no watermark, so
that a click counts however late it arrives.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trailmark import schemas
from trailmark.operators.ads import ad_stat, click_trend, last_minutes, minute_clicks, province_top_ads
from trailmark.sinks import overwrite_partitions
from trailmark.streaming.blacklist import EVERY_5_SECONDS, EVERY_10_SECONDS, start
from trailmark.streaming.tables import CountTable

PROVINCE_BUCKETS = 8


@dataclass(frozen=True)
class ProvinceTop:
    """The top ads of each date and province, kept up to date from totals per ad that batches add to.

    The totals are stored by date and bucket of the province. A batch reads the buckets of the provinces it has changed
    and ranks those provinces anew, from rows that are as many as their ads.
    """

    totals: CountTable
    path: str
    n: int = 3

    @classmethod
    def at(cls, spark: SparkSession, folder: str, n: int = 3) -> "ProvinceTop":
        totals = CountTable(
            spark, f"{folder}/ad_province_count", schemas.AD_PROVINCE_TOP3, by="province", buckets=PROVINCE_BUCKETS
        )
        return cls(totals, f"{folder}/ad_province_top3", n)

    def add(self, stat: DataFrame, batch_id: int) -> None:
        """Adds a batch's rows of the ad counts, and replaces the rows of the dates and provinces they change."""
        keys = ["date", "province"]
        per_ad = stat.groupBy(*keys, "ad_id").agg(F.sum("click_count").alias("click_count"))
        parts = self.totals.write(per_ad, batch_id)
        if not parts:
            return
        touched = self.totals.batch(batch_id, parts).select(*keys).distinct()
        counts = self.totals.rows(batch_id, parts).join(touched, keys, "left_semi")
        overwrite_partitions(province_top_ads(counts, self.n).hint("rebalance", "date"), self.path, keys)

    def read(self) -> DataFrame:
        return self.totals.spark.read.schema(schemas.AD_PROVINCE_TOP3).parquet(self.path)


def trend_table(spark: SparkSession, path: str, **options) -> CountTable:
    """Minute counts, stored by date and hour."""
    return CountTable(spark, path, schemas.AD_CLICK_TREND, by="hour", **options)


def add_stat(clicks: DataFrame, batch_id: int, stat: CountTable, top: ProvinceTop | None = None) -> None:
    """Adds one batch of clicks to `stat`, and brings the top ads up to date if they are asked for."""
    parts = stat.write(ad_stat(clicks), batch_id)
    if top and parts:
        top.add(stat.batch(batch_id, parts), batch_id)


def add_trend(clicks: DataFrame, batch_id: int, trend: CountTable) -> None:
    trend.write(click_trend(minute_clicks(clicks)), batch_id)


def ad_stat_stream(
    clicks: DataFrame,
    stat: CountTable,
    checkpoint: str,
    top: ProvinceTop | None = None,
    trigger: dict = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Keeps `stat` (date, province, city, ad_id, click_count) up to date and, if asked for, the top ads."""

    def run(batch: DataFrame, batch_id: int) -> None:
        add_stat(batch, batch_id, stat, top)

    return start(clicks.writeStream.foreachBatch(run), checkpoint, trigger)


def click_trend_stream(
    clicks: DataFrame, trend: CountTable, checkpoint: str, trigger: dict = EVERY_10_SECONDS
) -> StreamingQuery:
    """Keeps `trend` (date, hour, minute, ad_id, click_count) up to date."""

    def run(batch: DataFrame, batch_id: int) -> None:
        add_trend(batch, batch_id, trend)

    return start(clicks.writeStream.foreachBatch(run), checkpoint, trigger)


def last_hour(trend: CountTable, minutes: int = 60, until: datetime | None = None) -> DataFrame:
    """The stored counts of the `minutes` minutes up to `until` (UTC), by default the current time.

    Only the hours they fall in are listed and read; `trend` is stored by date and hour (`trend_table`). Minutes after
    `until` are left out.
    """
    until = (until or datetime.now(timezone.utc)).replace(tzinfo=None)
    before = min(timedelta(minutes=minutes - 1), until - datetime.min)
    hour = (until - before).replace(minute=0, second=0, microsecond=0)
    hours = [hour + timedelta(hours=k) for k in range((until - hour) // timedelta(hours=1) + 1)]
    parts = [(f"{h.year:04}-{h:%m-%d}", f"{h:%H}") for h in hours]
    text = F.concat_ws(" ", "date", F.concat_ws(":", "hour", "minute"))
    rows = trend.current(parts=parts)
    stamped = rows.withColumn("minute_start", F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")))
    clock = F.to_timestamp(F.lit(f"{until.year:04}-{until:%m-%d %H:%M}"), "yyyy-MM-dd HH:mm")
    return click_trend(last_minutes(stamped, minutes, clock, "minute_start"))
