from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import actions, pairs
from trailmark.operators import categories as C
from trailmark.operators.topn import top_n_per_group

COUNTS = ("category_id", "click_count", "order_count", "pay_count")


def test_counts_of_clicks_orders_and_payments(spark):
    log = actions(
        spark,
        {"click_category_id": 1},
        {"click_category_id": 1, "order_category_ids": "1,2,2", "pay_category_ids": ""},
        {"pay_category_ids": "11,x"},
        {},
    )
    assert pairs(C.category_counts(log), *COUNTS) == [(1, 2, 1, 0), (2, 0, 2, 0), (11, 0, 0, 1)]


def test_top_categories_break_ties_by_orders_payments_and_id(spark):
    rows = [(5, 3, 1, 1), (4, 3, 1, 1), (3, 3, 1, 2), (2, 3, 2, 0), (1, 2, 9, 9), (0, 2**40, 0, 0)]
    df = spark.createDataFrame(rows, "category_id long, click_count long, order_count long, pay_count long")
    assert [r.category_id for r in C.top_categories(df, 5).collect()] == [0, 2, 3, 4, 5]


def test_top_sessions_and_their_details(spark):
    rows = []
    for session, category, n in (("a", 1, 2), ("b", 1, 2), ("c", 1, 3), ("a", 2, 1), ("d", 3, 9)):
        rows += [{"session_id": session, "click_category_id": category}] * n
    log = actions(spark, *rows)
    top = spark.createDataFrame([(1,), (2,)], "category_id long")
    best = C.top_sessions_per_category(log, top, n=2)
    assert pairs(best, "category_id", "session_id", "click_count") == [(1, "a", 2), (1, "c", 3), (2, "a", 1)]
    once = C.top_session_details(log, best)
    assert once.count() == 6 and "category_id" not in once.columns
    repeated = C.top_session_details(log, best, per_category=True)
    assert repeated.groupBy("category_id").count().orderBy("category_id").collect() == [(1, 6), (2, 3)]


def test_top_n_is_the_same_beyond_the_group_limit_threshold(spark):
    df = spark.range(20_000).select(F.pmod("id", F.lit(3)).alias("g"), F.xxhash64("id").alias("v"), "id")
    order = [F.col("v").desc(), F.col("id")]
    usual = top_n_per_group(df, ["g"], order, 700, rank="r")
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        salted = top_n_per_group(df, ["g"], order, 700, rank="r")
        assert pairs(salted, "g", "id", "r") == pairs(usual, "g", "id", "r")
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)
