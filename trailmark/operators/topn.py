from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 256


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first `n` rows of each group in the given order, which should be total for repeatable results.

    Up to the engine's group-limit threshold every map task already drops all but its own first `n` rows of a
    group. Above it the same is done by hand: first within 256 slices of each group, then over their survivors.
    """
    number = "_rank" if rank is None else rank
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        inner = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = sliced.withColumn("_inner", F.row_number().over(inner)).where(F.col("_inner") <= n)
        df = df.drop("_slice", "_inner")
    ranked = df.withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    top = ranked.where(F.col(number) <= n)
    return top.drop(number) if rank is None else top
