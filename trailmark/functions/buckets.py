from __future__ import annotations

from pyspark.sql import Column

# fixed values: (name, lowest value, first value above); None is open
VISIT_BUCKETS = (
    ("1s_3s", 1, 4),
    ("4s_6s", 4, 7),
    ("7s_9s", 7, 10),
    ("10s_30s", 10, 30),
    ("30s_60s", 30, 60),
    ("1m_3m", 60, 180),
    ("3m_10m", 180, 600),
    ("10m_30m", 600, 1800),
    ("30m", 1800, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 4),
    ("4_6", 4, 7),
    ("7_9", 7, 10),
    ("10_30", 10, 30),
    ("30_60", 30, 60),
    ("60", 60, None),
)


def in_bucket(c: Column, low: int, high: int | None) -> Column:
    return (c >= low) if high is None else (c >= low) & (c < high)
