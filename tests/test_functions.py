from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from trailmark import functions as X
from trailmark.functions.sql import register_sql_functions


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first().x


def test_ratio_is_half_up_on_exact_numbers(spark):
    cases = {(29, 200): 0.15, (57, 200): 0.29, (1, 3): 0.33, (2, 3): 0.67, (5, 1): 5.0, (0, 7): 0.0}
    for (n, d), want in cases.items():
        got = one(spark, X.ratio(F.col("n").cast("long"), F.col("d").cast("long")), n=n, d=d)
        assert got == want, (n, d)
    assert one(spark, X.ratio(F.col("n").cast("long"), F.col("d").cast("long")), n=1, d=0) is None


def test_ratio_stays_exact_for_large_counts(spark):
    n, d = 10**13 - 1, 2 * 10**13
    assert one(spark, X.ratio(F.col("n"), F.col("d")), n=n, d=d) == 0.5
    n, d = 145 * 10**10 - 1, 10**13
    assert one(spark, X.ratio(F.col("n"), F.col("d")), n=n, d=d) == 0.14


def test_csv(spark):
    assert one(spark, X.csv_longs(F.col("c")), c="1,11, 2,,x,9999999999") == [1, 11, 2, 9999999999]
    assert one(spark, X.csv_longs(F.col("c")), c="") == []
    assert one(spark, X.csv_longs(F.lit(None).cast("string"))) is None
    assert one(spark, X.csv_strings(F.col("c")), c="a, b,,c") == ["a", "b", "c"]
    assert one(spark, X.join_csv(F.array(F.lit(1), F.lit(2)))) == "1,2"
    assert one(spark, X.trim_comma(F.col("c")), c=",a,b,") == "a,b"


def test_texts(spark):
    assert one(spark, X.concat_long_string(F.col("i"), F.col("t")), i=7, t="x") == "7:x"
    assert one(spark, X.json_field(F.col("j"), "product_status"), j='{"product_status": 0}') == "0"
    assert one(spark, X.json_field(F.col("j"), "product_status"), j="{broken") is None
    assert one(spark, X.is_blank(F.col("t")), t="") is True
    assert [one(spark, X.pad2(F.col("i")), i=i) for i in (3, 12, 123)] == ["03", "12", "123"]


def test_group_concat_distinct_uses_whole_values_and_skips_nulls(spark):
    df = spark.createDataFrame([("11:a",), ("1:a",), (None,), ("11:a",)], "c string")
    assert df.agg(X.group_concat_distinct(F.col("c")).alias("x")).first().x == "11:a,1:a"


def test_times(spark):
    noon = datetime(2024, 3, 5, 9, 7, 8)
    assert one(spark, X.parse_time(F.col("c")), c="2024-03-05 9:07:08") == noon
    assert one(spark, X.parse_time(F.col("c")), c="2024-03-05 09:07:08") == noon
    assert one(spark, X.parse_time(F.col("c")), c="never") is None
    for make, want in (
        (X.format_time, "2024-03-05 09:07:08"),
        (X.format_date, "2024-03-05"),
        (X.date_key, "20240305"),
        (X.minute_key, "202403050907"),
        (X.hour_key, "2024-03-05_09"),
    ):
        assert one(spark, make(F.col("t")), t=noon) == want
    assert one(spark, X.parse_date_key(F.col("c")), c="20240305") == date(2024, 3, 5)
    assert one(spark, X.parse_date_key(F.col("c")), c="x") is None
    assert one(spark, X.seconds_between(F.col("a"), F.col("b")), a=noon, b=datetime(2024, 3, 5, 9, 8, 8)) == 60
    assert one(spark, F.date_diff(X.today(), X.yesterday())) == 1


def test_labels(spark):
    areas = ["华北", "华东", "华南", "华中", "西北", "西南", "东北"]
    df = spark.createDataFrame([(a,) for a in areas], "a string")
    got = [r.x[0] for r in df.select(X.area_level(F.col("a")).alias("x")).collect()]
    assert got == ["A", "A", "B", "B", "C", "C", "D"]
    assert one(spark, X.area_level(F.col("a"), {"near": ["x"]}, "far"), a="x") == "near"
    assert one(spark, X.area_level(F.col("a"), {}, "far"), a="x") == "far"
    status = {'{"product_status": 0}': "self", '{"product_status": 1}': "third party", "{}": "third party"}
    status["{bad"] = "third party"
    for text, want in status.items():
        assert one(spark, X.product_status(F.col("j")), j=text) == want


def test_sql_functions(spark):
    register_sql_functions(spark)
    rows = [("11", "a", '{"product_status": 0}'), ("1", "a", "{}"), ("11", "a", "{bad")]
    spark.createDataFrame(rows, "id string, name string, info string").createOrReplaceTempView("sql_rows")
    got = spark.sql(
        """
        SELECT listagg(DISTINCT place, ',') WITHIN GROUP (ORDER BY place) AS places,
          group_concat_distinct(collect_set(place), ',') AS same, group_concat_distinct(collect_list(place), '|') AS bars,
          count_if(status = '0') AS own
        FROM (
          SELECT concat_long_string(CAST(id AS BIGINT), name, ':') AS place,
            json_field(info, 'product_status') AS status
          FROM sql_rows)"""
    ).first()
    assert (got.places, got.same, got.bars, got.own) == ("11:a,1:a", "11:a,1:a", "11:a|1:a", 1)
