"""Optional predicates: an absent parameter lets every row pass, missing data fails."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmark.params import TaskParams


def between_bounds(c: Column, low: Any | None, high: Any | None) -> Column | None:
    """Inclusive range; applies only when both bounds are given."""
    return None if low is None or high is None else c.between(low, high)


def one_of(c: Column, allowed: Sequence[Any] | None) -> Column | None:
    return None if allowed is None else c.isin(list(allowed))


def shares_any(c: Column, allowed: Sequence[Any] | None, element: str = "string") -> Column | None:
    """The array column, of the given element type, has an element in common with the allowed values."""
    if allowed is None:
        return None
    return F.arrays_overlap(c, F.array(*[F.lit(v) for v in allowed]).cast(f"array<{element}>"))


def equals(c: Column, value: Any | None) -> Column | None:
    return None if value is None else c == value


def all_of(*conditions: Column | None) -> Column | None:
    """Conjunction of the conditions that apply, or None."""
    given = [c for c in conditions if c is not None]
    return reduce(and_, given) if given else None


def user_condition(params: TaskParams) -> Column | None:
    return all_of(
        between_bounds(F.col("age"), params.start_age, params.end_age),
        one_of(F.col("professional"), params.professionals),
        one_of(F.col("city"), params.cities),
        one_of(F.col("sex"), params.sex),
    )


def session_condition(params: TaskParams) -> Column | None:
    return all_of(
        user_condition(params),
        shares_any(F.col("search_keywords"), params.keywords),
        shares_any(F.col("click_category_ids"), params.category_ids, "bigint"),
    )
