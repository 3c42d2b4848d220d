"""One key holding a third of the rows: the work is spread, the result stays whole."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import functions as F

from fixtures import pairs
from trailmark.operators import ads, pages, sessions
from trailmark.operators.skew import broadcast_bounded, hot_keys

N = 60_000


@contextmanager
def settings(spark, **conf):
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def no_broadcast(spark):
    return settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.optimizer.runtime.bloomFilter.enabled": "false",
        },
    )


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def rows(spark, key):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, N, 1, 8).select("id", hot.alias(key))


def test_semi_join_splits_a_hot_session(spark, tmp_path):
    actions = rows(spark, "n").select(F.concat(F.lit("s"), "n").alias("session_id"), F.col("id").alias("page_id"))
    actions.where("page_id % 2 = 0").select("session_id").distinct().write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    with no_broadcast(spark):
        details = sessions.session_details(actions, kept)
        got = details.agg(F.count("*"), F.sum("page_id")).first()
        details.write.format("noop").mode("overwrite").save()
        df = sessions.session_details(actions, kept)
        df.collect()
        assert "skew=true" in final_plan(df)
    want = [i for i in range(N) if i % 3 == 0 or i % 2 == 0]
    assert tuple(got) == (len(want), sum(want))


def test_blacklist_join_splits_a_hot_user(spark, tmp_path):
    clicks = rows(spark, "user_id").select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 10).alias("ts"),
        F.lit("p").alias("province"),
        F.lit("c").alias("city"),
        "user_id",
        (F.col("id") % 7).alias("ad_id"),
    )
    listed = spark.createDataFrame(
        [(0, "2024-01-02"), (1, "2024-01-01")], "user_id long, flagged_date string"
    )
    listed.write.parquet(str(tmp_path / "black"))
    black = spark.read.parquet(str(tmp_path / "black"))
    broadcast = ads.clicks_until_flagged(clicks, black)
    want = broadcast.agg(F.count("*"), F.sum("user_id"), F.max(F.when(F.col("user_id") == 0, F.col("ts")))).first()
    with no_broadcast(spark):
        df = ads.clicks_until_flagged(clicks, black)
        df.collect()
        assert "skew=true" in final_plan(df)
        got = df.agg(F.count("*"), F.sum("user_id"), F.max(F.when(F.col("user_id") == 0, F.col("ts")))).first()
    assert tuple(got) == tuple(want)
    assert want[0] == N - N // 3 + len([i for i in range(0, N, 3) if i * 10 < 2 * 86400])
    assert want[2] == datetime(2024, 1, 2, 23, 59, 30)


def test_hot_session_is_cut_into_ranges(spark):
    log = rows(spark, "n").select(
        F.concat(F.lit("s"), "n").alias("session_id"),
        (F.col("id") % 4).alias("page_id"),
        F.timestamp_seconds(F.col("id")).alias("action_time"),
        F.col("id").alias("event_id"),
    )
    # the hot session sees ids 0, 3, 6, ...: pages 0, 3, 2, 1, 0, ...
    df = pages.page_pair_counts(log, [3, 2, 1, 0], ["event_id"], hot_rows=10_000)
    assert pairs(df, "from_page", "to_page", "pair_count") == [(1, 0, 4999), (2, 1, 5000), (3, 2, 5000)]
    df.collect()
    assert "rangepartitioning" in final_plan(df)


def test_missing_session_ids_are_one_session(spark):
    log = spark.range(0, 9_000, 1, 8).select(
        F.lit(None).cast("string").alias("session_id"),
        (F.col("id") % 3).alias("page_id"),
        F.timestamp_seconds(F.col("id")).alias("action_time"),
    )
    for hot_rows in (None, 1_000):
        df = pages.page_pair_counts(log, [0, 1, 2], hot_rows=hot_rows)
        assert pairs(df, "from_page", "to_page", "pair_count") == [(0, 1, 3000), (1, 2, 3000)]
    df.collect()
    assert "rangepartitioning" in final_plan(df)


def test_hot_keys_are_all_above_the_limit(spark):
    df = rows(spark, "n")
    assert pairs(hot_keys(df, ["n"], 10_000), "n") == [(0,)]
    assert hot_keys(df, ["n"], 30_000).isEmpty()
    assert hot_keys(df, ["n"], 1).count() == 1 + N - N // 3


def test_hot_session_of_equal_rows(spark):
    # one page loaded again and again within a second, between two others
    log = spark.range(0, 30_002, 1, 8).select(
        F.lit("s").alias("session_id"),
        F.when(F.col("id") == 0, 7).when(F.col("id") == 30_001, 9).otherwise(8).cast("long").alias("page_id"),
        F.timestamp_seconds(F.when(F.col("id") == 0, 0).when(F.col("id") == 30_001, 9).otherwise(5)).alias("action_time"),
    )
    for flow in ([7, 8, 8, 9], [8, 9], [9, 8]):
        usual, hot = (pages.page_conversion(log, flow, hot_rows=h) for h in (None, 1_000))
        assert sorted(map(tuple, hot.collect())) == sorted(map(tuple, usual.collect()))
    assert "rangepartitioning" in final_plan(hot)
    assert pairs(pages.page_pair_counts(log, [7, 8, 8], hot_rows=1_000), "from_page", "to_page", "pair_count") == [
        (7, 8, 1),
        (8, 8, 29_999),
    ]


def test_broadcasts_are_bounded(spark):
    small, large = spark.range(5), spark.range(50)

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_bounded(large, 1000)) and not hinted(broadcast_bounded(large, 10**6))
