"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from trailmark.operators import ads, categories, products, sampling, sessions
from trailmark.plans.catalog import QUERIES
from trailmark.sources import standin

BATCH_QUERIES = sorted(name for name in QUERIES if not name.endswith("_stream"))


def plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_top_n_drops_rows_before_the_shuffle(spark, sf_dir):
    clicks = ads.parse_ad_log(standin.ad_log_lines(standin.events(spark, sf_dir), spark, sf_dir))
    actions = standin.user_visit_action(spark, sf_dir)
    top = categories.top_categories(categories.category_counts(actions))
    for df in (
        ads.province_top_ads(ads.ad_stat(clicks)),
        categories.top_sessions_per_category(actions, top),
        products.area_top_products(actions, standin.city_info(spark, sf_dir), standin.product_info(spark, sf_dir)),
    ):
        text = plan(df)
        assert re.search(r"WindowGroupLimit .* Partial", text) and re.search(r"WindowGroupLimit .* Final", text)


def test_area_top_reads_the_clicks_once(spark, sf_dir):
    text = plan(
        products.area_top_products(
            standin.user_visit_action(spark, sf_dir),
            standin.city_info(spark, sf_dir),
            standin.product_info(spark, sf_dir),
        )
    )
    assert "ReusedExchange" in text
    assert text.count("events.parquet") == 1


def test_page_flow_without_hot_sessions_is_one_window(spark, sf_dir):
    text = plan(QUERIES["page_conversion"](spark, sf_dir))
    assert "rangepartitioning" not in text
    assert text.count("lag(page_id") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in text


def test_stats_carry_no_lists_through_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["session_stats"](spark, sf_dir))
    assert "collect_set" not in text and "ObjectHashAggregate" not in text
    assert "search_keyword" not in text


def test_category_counts_take_one_shuffle(spark, sf_dir):
    text = plan(categories.category_counts(standin.user_visit_action(spark, sf_dir)))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_details_and_samples_are_semi_joins(spark, sf_dir):
    actions, users = standin.user_visit_action(spark, sf_dir), standin.user_info(spark, sf_dir)
    some = sessions.session_aggregate(actions, users)
    assert "LeftSemi" in plan(sessions.session_details(actions, some))
    assert "LeftSemi" in plan(sampling.sample_details(sampling.sample_sessions(some), actions))


def test_date_filter_reaches_the_scan(spark, tmp_path):
    from trailmark.sources.tables import actions_between

    path = str(tmp_path / "log")
    day = "cast(date_add(date'2024-01-01', int(id)) as string) session_date"
    log = spark.range(3).selectExpr("id", day, "'2024-01-01 1:00:00' action_time")
    log.write.partitionBy("session_date").parquet(path)
    stored = spark.read.schema("id long, action_time string, session_date string").parquet(path)
    df = actions_between(stored, "2024-01-02", "2024-01-02")
    text = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*session_date[^\]]*2024-01-02", text)
    assert df.count() == 1


def test_building_a_query_starts_no_job(spark, sf_dir):
    actions = standin.user_visit_action(spark, sf_dir)
    cities, items = standin.city_info(spark, sf_dir), standin.product_info(spark, sf_dir)
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        products.area_top_products(actions, cities, items)
        products.area_product_clicks(products.product_clicks(actions), cities)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_last_minutes_skip_files_by_time(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "clicks")
    spark.range(10).selectExpr("timestamp_seconds(id * 60) ts", "'p' province", "'c' city", "id user_id", "id ad_id").write.parquet(path)
    recent = ads.last_minutes(spark.read.parquet(path), 3, F.timestamp_seconds(F.lit(400)))
    text = plan(ads.click_trend(ads.minute_clicks(recent)))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", text)
    assert recent.count() == 3


def test_every_table_may_be_a_folder_of_files(spark, sf_dir, tmp_path):
    for name in ("region", "nation", "customer", "part", "events"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("ad_stat_stream", "ad_province_top3_stream", "ad_click_trend_stream", "session_stats", "ad_stat"):
        one, many = (QUERIES[name](spark, folder) for folder in (sf_dir, str(tmp_path)))
        assert sorted(map(tuple, one.collect())) == sorted(tuple(r) for r in many.select(one.columns).collect())


def test_saved_log_is_pruned_by_a_table_of_dates(spark, tmp_path):
    from pyspark.sql import functions as F

    from trailmark.sources.tables import actions_between, actions_on, save_actions

    day = "cast(date_add(date'2024-01-01', int(id % 9)) as string) session_date"
    log = spark.range(900).selectExpr("id", day, "timestamp_seconds(1704067200 + id) action_time", "'s' || id session_id")
    save_actions(log, "saved_log", str(tmp_path / "log"))
    save_actions(log.limit(1), "saved_log", str(tmp_path / "log"))  # adds to it
    try:
        stored = spark.table("saved_log")
        text = plan(actions_between(stored, "2024-01-02", "2024-01-03"))
        assert re.search(r"PartitionFilters: \[[^\]]*session_date[^\]]*2024-01-02", text)
        dates = spark.createDataFrame([("2024-01-04", 1), ("2024-01-04", 2), ("2023-01-01", 1)], "session_date string, n int")
        dates.write.parquet(str(tmp_path / "dates"))
        wanted = spark.read.parquet(str(tmp_path / "dates")).where(F.col("n") > 0)
        some = actions_on(stored, wanted)
        assert "dynamicpruning" in plan(some)
        assert some.count() == 100 and stored.count() == 901
        assert "Exchange hashpartitioning" not in plan(actions_between(stored, "2024-01-02", "2024-01-03"))
    finally:
        spark.sql("DROP TABLE saved_log")


def test_counts_beside_a_result_take_no_other_scan(spark, sf_dir):
    from pyspark.sql import functions as F

    from trailmark.operators.metrics import Metrics

    log, people = standin.user_visit_action(spark, sf_dir), standin.user_info(spark, sf_dir)
    some, metrics = people.where(F.col("user_id") % 3 != 0), Metrics()
    counted = sessions.session_summary(log, some, None, metrics)
    text = plan(counted)
    assert text.count("events.parquet") == 1 and "CollectMetrics" in text
    every = sessions.session_summary(log, people).count()
    assert metrics.values() == {"unmatched_sessions": every - counted.count()}
    cities = standin.city_info(spark, sf_dir).where(F.col("city_id") > 4)
    clicks, metrics = products.product_clicks(log), Metrics()
    plain = products.area_product_clicks(clicks, cities)
    assert sorted(map(tuple, products.area_product_clicks(clicks, cities, metrics).collect())) == sorted(map(tuple, plain.collect()))
    assert metrics.values() == {"clicks_in_unknown_cities": clicks.where("city_id <= 4").count()}
    # nothing is left of a result: its rows were all unmatched
    lost, nobody = Metrics(), people.where(F.col("user_id") < 0)
    assert sessions.session_stats(sessions.session_summary(log, nobody, None, lost)).first().session_count == 0
    assert lost.values() == {"unmatched_sessions": log.select("session_id").distinct().count()}
    with pytest.raises(ValueError, match="counted already"):
        metrics.count(log, "clicks_in_unknown_cities", F.count("*"))
