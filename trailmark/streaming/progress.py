"""What a stream of ad log lines has seen, batch by batch: lines, rejects, late clicks. Counted while clicks are stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark import schemas
from trailmark.operators.ads import ad_log_valid, parse_fields
from trailmark.operators.metrics import Metrics
from trailmark.streaming import files
from trailmark.streaming.tables import GrowingSet

LATE_MINUTES = 60


@dataclass(frozen=True)
class Progress:
    """One row per batch. A click is late if it is more than `late_minutes` older than the newest click of the batches
    before; what those have seen is one line in the file NEWEST. Late clicks count like others."""

    batches: GrowingSet
    late_minutes: int = LATE_MINUTES

    @classmethod
    def at(cls, spark: SparkSession, folder: str) -> "Progress":
        return cls(GrowingSet(spark, f"{folder}/ad_stream_progress", schemas.AD_STREAM_PROGRESS))

    @property
    def _newest(self) -> str:
        return f"{self.batches.path}/NEWEST"

    def newest_before(self, batch_id: int) -> int | None:
        """Microseconds of the newest click of earlier batches, also for a batch that runs again."""
        text = files.read_text(self.batches.spark, self._newest)
        if text is None:
            return None
        batch, before, newest = text.split()
        value = before if int(batch) >= batch_id else newest
        return None if value == "none" else int(value)

    def watched(self, lines: DataFrame, batch_id: int, metrics: Metrics) -> DataFrame:
        """The clicks of a batch of lines (`value`), with counts that are known when the clicks have been written."""
        before = self.newest_before(batch_id)
        at = F.unix_micros("_click.ts")
        late = F.lit(False) if before is None else at < before - self.late_minutes * 60_000_000
        fields = parse_fields(lines)
        fields = metrics.count(fields, "lines", F.count(F.lit(1)))
        fields = metrics.count(fields, "rejects", F.count_if(~F.coalesce(ad_log_valid(), F.lit(False))))
        fields = metrics.count(fields, "late", F.count_if(ad_log_valid() & late))
        fields = metrics.count(fields, "newest", F.max(F.when(ad_log_valid(), at)))
        return fields.where(ad_log_valid()).select("_click.*")

    def note(self, batch_id: int, metrics: Metrics) -> dict[str, int]:
        """Stores a batch's counts and returns them."""
        values = metrics.values()
        newest, before = values.pop("newest"), self.newest_before(batch_id)
        seen = [x for x in (newest or None, before) if x is not None]
        text = f"{batch_id} {'none' if before is None else before} {max(seen) if seen else 'none'}"
        schema = schemas.AD_STREAM_PROGRESS
        row = self.batches.spark.createDataFrame([tuple(values[c] for c in schema.names)], schema)
        self.batches.write(row, batch_id)
        files.replace_text(self.batches.spark, self._newest, text)
        return values
