"""Write semantics of the result tables on files and over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replaces the whole table at once."""
    df.write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replaces only the partitions that occur in `df`: delete by key, then insert."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def jdbc_options(url: str, table: str, batch_rows: int = 10_000, **more: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), **more}


def append_jdbc(df: DataFrame, options: Mapping[str, str]) -> None:
    df.write.format("jdbc").mode("append").options(**options).save()


def overwrite_jdbc(df: DataFrame, options: Mapping[str, str]) -> None:
    """Truncates the table, then inserts; its definition stays."""
    df.write.format("jdbc").mode("overwrite").options(**options, truncate="true").save()
