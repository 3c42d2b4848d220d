"""Session settings the package is tuned for. Every setting is optional: results do not depend on them,
except for the UTC time zone, in which dates and hours are cut."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app: str = "trailmark", master: str | None = None, hive: bool = False, **conf: str
) -> SparkSession:
    """`hive` resolves table names in the Hive metastore instead of the session's own catalog."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
