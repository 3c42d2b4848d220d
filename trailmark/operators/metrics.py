"""Counts beside a result: rows are counted in the pass that makes the result, without another scan."""

from __future__ import annotations

from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(seen: Observation) -> dict[str, Any] | None:
    """What an observation has seen; None if adaptive execution has replaced that part of the plan, which it does where
    no rows are left."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return None


class Metrics:
    """Named counts of one result. They are known once an action on the result has finished; each name counts once.

    A result that is computed several times is counted in its first action. If nothing is left of a result, what it was
    made from may have to be counted once more.
    """

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, DataFrame, Column]] = {}

    def count(self, df: DataFrame, name: str, counted: Column) -> DataFrame:
        """`df` with a count beside it; `counted` is an aggregate over its rows."""
        if name in self._seen:
            raise ValueError(f"{name} is counted already")
        self._seen[name] = Observation(), df, counted.alias(name)
        return df.observe(self._seen[name][0], counted.alias(name))

    def values(self) -> dict[str, int]:
        """Waits for the first action. No rows count as 0."""
        out = {}
        for name, (seen, df, counted) in self._seen.items():
            found = observed(seen)
            out[name] = (df.agg(counted).first()[0] if found is None else found[name]) or 0
        return out


def inner_join(
    left: DataFrame, right: DataFrame, key: str, metrics: Metrics | None, name: str, weight: Column | None = None
) -> DataFrame:
    """Inner join with a side whose `key` is unique; how many rows of `left` find nothing there is counted as `name`.

    `weight` is what a row counts for, by default one.
    """
    if metrics is None:
        return left.join(right, key)
    joined = left.join(right.withColumn("_found", F.lit(True)), key, "left")
    lost = F.when(F.col("_found").isNull(), F.lit(1) if weight is None else weight)
    return metrics.count(joined, name, F.sum(lost)).where("_found").drop("_found")
