"""A join of rows with one measured row per key, where a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 1000  # keys of more than one in so many rows are hot, so there are fewer hot keys than that


def with_measures(rows: DataFrame, measures: DataFrame, key: str, copies: str) -> DataFrame:
    """`rows` with the other columns of `measures`, which has one row for each key that `rows` holds and in `copies` how
    many rows hold it. Null keys match nothing; `measures` should be a stored table, as it is read more than once.

    Hot keys are fewer than HOT whatever the input, and are broadcast; rows of others are shuffled, and none of those
    keys has more than one in HOT of all rows.
    """
    total = measures.agg(F.sum(copies)).first()[0] or 0
    is_hot = F.col(copies) * HOT > F.lit(total)
    hot, cold = measures.where(is_hot).drop(copies), measures.where(~is_hot).drop(copies)
    few = F.broadcast(hot)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(few, key).unionByName(others.join(cold, key))
