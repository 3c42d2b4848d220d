"""Guards against data that outgrows one task: checked broadcasts and hot-key detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def broadcast_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a side known to hold at most `max_rows` rows, left to the planner if that is many."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """The keys with `min_rows` rows or more: at most one for every `min_rows` rows of `df`.

    All rows are counted, so rows that are equal in every column are found too; only the keys are read.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") >= min_rows).select(*keys)
