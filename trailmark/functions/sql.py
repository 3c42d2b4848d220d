"""The text helpers under their names in SQL. They are SQL functions, replaced by their body when planned."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "concat_long_string(number BIGINT, text STRING, sep STRING)": "concat_ws(sep, CAST(number AS STRING), text)",
    "json_field(json STRING, field STRING)": "get_json_object(json, concat('$.', field))",
    "group_concat_distinct(texts ARRAY<STRING>, sep STRING)": "array_join(array_sort(array_distinct(texts)), sep)",
}


def register_sql_functions(spark: SparkSession) -> None:
    """Makes `concat_long_string`, `json_field` and `group_concat_distinct` known to the session's SQL.

    SQL functions are no aggregates, so the texts of a group are gathered first: `group_concat_distinct(collect_set(x), ',')`
    says the same as `listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)`.
    """
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
