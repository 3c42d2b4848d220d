"""Dynamic blacklist: clicks of listed users are dropped, users clicking one ad too often in a day get listed.

One function per micro-batch, as the filter needs what earlier batches found. A batch only reads what batches
before it wrote, and writes only its own partitions, hence running it again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from trailmark import schemas
from trailmark.operators.ads import (
    BLACKLIST_THRESHOLD,
    ad_log_rejects,
    over_threshold,
    parse_ad_log,
    user_daily_clicks,
)
from trailmark.operators.metrics import Metrics
from trailmark.streaming.progress import Progress
from trailmark.streaming.tables import BatchTable, CountTable, GrowingSet, Part

USER_BUCKETS = 32


@dataclass(frozen=True)
class BlacklistTables:
    blacklist: GrowingSet
    user_clicks: CountTable
    clicks: BatchTable
    rejects: BatchTable
    progress: Progress

    @classmethod
    def at(cls, spark: SparkSession, folder: str) -> "BlacklistTables":
        return cls(
            GrowingSet(spark, f"{folder}/ad_blacklist", schemas.AD_BLACKLIST),
            CountTable(
                spark, f"{folder}/ad_user_click_count", schemas.AD_USER_CLICK_COUNT, by="user_id", buckets=USER_BUCKETS
            ),
            BatchTable(spark, f"{folder}/ad_clicks", schemas.CLICKS),
            BatchTable(spark, f"{folder}/ad_log_rejects", schemas.AD_LOG_REJECTS),
            Progress.at(spark, folder),
        )


def drop_listed(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """`blacklist` as read from its table, whose size decides whether it is broadcast."""
    return clicks.join(blacklist, "user_id", "left_anti")


def newly_listed(
    tables: BlacklistTables, batch_id: int, parts: list[Part], threshold: int
) -> DataFrame:
    """Users whose count of a day and ad, up to this batch, reached the threshold through this batch.

    Only the parts of this batch are read, dates and buckets of users, and of them only its keys are summed.
    """
    keys = tables.user_clicks.keys
    touched = tables.user_clicks.batch(batch_id, parts).select(*keys)
    rows = tables.user_clicks.rows(batch_id, parts)
    counts = tables.user_clicks.combine(rows.join(touched, keys, "left_semi"))
    users = over_threshold(counts, threshold).select("user_id").distinct()
    return users.join(tables.blacklist.before(batch_id), "user_id", "left_anti")


def process_batch(
    clicks: DataFrame,
    batch_id: int,
    tables: BlacklistTables,
    threshold: int = BLACKLIST_THRESHOLD,
    then: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Stores the clicks the blacklist lets through and what follows from them; `then` gets the stored clicks."""
    if not tables.clicks.has(batch_id):
        # of a batch whose clicks are stored already, `clicks` is not looked at:
        # readers of this table may have seen an earlier run's files, so a second run leaves them as they are
        tables.clicks.write(drop_listed(clicks, tables.blacklist.before(batch_id)), batch_id)
    kept = tables.clicks.batch(batch_id)
    parts = tables.user_clicks.write(user_daily_clicks(kept), batch_id)
    if then:
        then(kept, batch_id)
    if parts:
        tables.blacklist.write(newly_listed(tables, batch_id, parts, threshold), batch_id)


def start(writer: DataStreamWriter, checkpoint: str, trigger: dict) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


EVERY_5_SECONDS = {"processingTime": "5 seconds"}
EVERY_10_SECONDS = {"processingTime": "10 seconds"}
ALL_AVAILABLE = {"availableNow": True}


def blacklist_stream(
    lines: DataFrame,
    tables: BlacklistTables,
    checkpoint: str,
    threshold: int = BLACKLIST_THRESHOLD,
    trigger: dict = EVERY_5_SECONDS,
    then: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Runs the blacklist over a stream of ad log lines (column `value`). Lines that are no clicks are stored too, and
    lines, rejects and late clicks are counted while the clicks are stored."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select("value").persist()  # the source is read once
        try:
            if tables.clicks.has(batch_id):  # a second run: clicks are there, what follows may not be
                rejected, clicks = not ad_log_rejects(batch).isEmpty(), parse_ad_log(batch)
                if tables.progress.batches.read().where(F.col("batch_id") == batch_id).isEmpty():
                    seen = Metrics()
                    tables.progress.watched(batch, batch_id, seen).write.format("noop").mode("overwrite").save()
                    tables.progress.note(batch_id, seen)
            else:
                seen = Metrics()
                clicks = drop_listed(tables.progress.watched(batch, batch_id, seen), tables.blacklist.before(batch_id))
                tables.clicks.write(clicks, batch_id)
                rejected = tables.progress.note(batch_id, seen)["rejects"] > 0
            if rejected:
                tables.rejects.write(ad_log_rejects(batch), batch_id)
            process_batch(clicks, batch_id, tables, threshold, then)
        finally:
            batch.unpersist()

    return start(lines.writeStream.foreachBatch(run), checkpoint, trigger)


def filtered_clicks_stream(tables: BlacklistTables) -> DataFrame:
    """The clicks that passed the blacklist, as a stream for other uses than the counts."""
    spark, schema = tables.clicks.spark, tables.clicks.schema
    return spark.readStream.schema(schema).parquet(tables.clicks.path)
