from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(n: Column, d: Column) -> Column:
    """Whole-number quotient of two long columns; NULL when the divisor is 0."""
    return F.call_function("div", n, F.nullif(d, F.lit(0).cast("long")))


def ratio(n: Column, d: Column, scale: int = 2) -> Column:
    """n / d rounded half up to `scale` decimals, decided in whole numbers so that ties are exact.

    NULL when d is 0.
    """
    unit = 10**scale
    return int_div(n * (2 * unit) + d, d * 2).cast("double") / F.lit(float(unit))
