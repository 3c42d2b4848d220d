from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmark.functions.text import json_field

# fixed values: level -> areas; every other area has OTHER_LEVEL
AREA_LEVELS = {
    "A level": ("华北", "华东"),
    "B level": ("华南", "华中"),
    "C level": ("西北", "西南"),
}
OTHER_LEVEL = "D level"


def area_level(
    area: Column, levels: Mapping[str, Sequence[str]] | None = None, other: str = OTHER_LEVEL
) -> Column:
    chain = F
    for level, areas in (AREA_LEVELS if levels is None else levels).items():
        chain = chain.when(area.isin(list(areas)), level)
    return F.lit(other) if chain is F else chain.otherwise(other)


def product_status(extend_info: Column) -> Column:
    """'self' for status 0; anything else, a missing status included, is 'third party'."""
    return F.when(json_field(extend_info, "product_status") == "0", "self").otherwise("third party")
