from __future__ import annotations

import pytest

from fixtures import actions, pairs, users
from trailmark import schemas, sinks
from trailmark.params import TaskParams
from trailmark.plans import jobs
from trailmark.scratch import shared_folder, written
from trailmark.sources import tables as T

PARAMS = TaskParams.parse(
    {"startDate": "2024-01-01", "endDate": "2024-01-01", "sex": "male", "targetPageFlow": "1,2"}
)


def log(spark):
    rows = [
        {"session_id": "a", "page_id": 1, "click_category_id": 3, "click_product_id": 7},
        {"session_id": "a", "page_id": 2, "at": 5, "order_category_ids": "3,4"},
        {"session_id": "b", "page_id": 1, "at": 7, "click_category_id": 3, "search_keyword": "w"},
        {"session_id": "c", "user_id": 2, "click_category_id": 3},
        {"session_id": "d", "at": 24 * 3600, "click_category_id": 3},
    ]
    return actions(spark, *rows)


def people(spark):
    return users(spark, (1, "u", "n", 30, "p", "c", "male"), (2, "u", "n", 30, "p", "c", "female"))


def read(spark, out, name):
    df = spark.read.parquet(f"{out}/{name}")
    assert df.schema.names == getattr(schemas, name.upper()).names
    return df


def test_session_job_twice(spark, tmp_path):
    out = str(tmp_path / "out")
    for task in (1, 2):
        jobs.session_job(log(spark), people(spark), PARAMS, task, out)
    stats = read(spark, out, "session_aggr_stat")
    assert pairs(stats, "task_id", "session_count", "visit_length_4s_6s_ratio") == [(1, 2, 0.5), (2, 2, 0.5)]
    drawn = read(spark, out, "session_random_extract").where("task_id = 1")
    assert pairs(drawn, "session_id", "start_time", "search_keywords", "click_category_ids") == [
        ("a", "2024-01-01 08:00:00", "", "3"),
        ("b", "2024-01-01 08:00:07", "w", "3"),
    ]
    # the sampled sessions' actions and the top sessions' actions, for each task
    details = read(spark, out, "session_detail")
    assert pairs(details.groupBy("task_id", "session_id").count(), "*") == [
        (1, "a", 4),
        (1, "b", 2),
        (2, "a", 4),
        (2, "b", 2),
    ]
    top = read(spark, out, "top10_category")
    assert pairs(top, "*") == [(2, 3, 2, 1, 0), (2, 4, 0, 1, 0)]
    active = read(spark, out, "top10_category_session")
    assert pairs(active, "*") == [(2, 3, "a", 1), (2, 3, "b", 1)]


def test_page_and_area_jobs(spark, tmp_path):
    out = str(tmp_path)
    jobs.page_job(log(spark), PARAMS, 5, out)
    assert pairs(read(spark, out, "page_split_convert_rate"), "*") == [(5, "1_2=0.33")]
    cities = spark.createDataFrame([(1, "x", "华东")], schemas.CITIES)
    products = spark.createDataFrame([(7, "p", "{}")], schemas.PRODUCTS)
    for task in (6, 7):
        jobs.area_job(log(spark), cities, products, PARAMS, task, out)
    got = pairs(read(spark, out, "area_top3_product"), "*")
    assert got == [(7, "华东", "A level", 7, "1:x", 1, "p", "third party")]


def test_missing_dates_stop_a_job_before_it_starts(spark, tmp_path):
    with pytest.raises(ValueError, match="start_date"):
        jobs.page_job(log(spark), TaskParams.parse({"targetPageFlow": "1,2"}), 1, str(tmp_path))
    with pytest.raises(ValueError, match="page_flow"):
        jobs.page_job(log(spark), TaskParams.parse({"startDate": "a", "endDate": "b"}), 1, str(tmp_path))


def test_actions_between_types_text_times(spark):
    rows = [("2024-01-01", "2024-01-01 8:00:05"), ("2024-01-02", "2024-01-02 08:00:00"), ("2024-01-03", "x")]
    df = spark.createDataFrame(rows, "session_date string, action_time string")
    got = T.actions_between(df, "2024-01-01", "2024-01-02")
    assert got.schema["action_time"].dataType.typeName() == "timestamp" and got.count() == 2
    assert T.typed_actions(df).where("action_time is null").count() == 1


def test_table_by_path_or_name(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert T.read_table(spark, "t", {"t": str(tmp_path / "t")}).count() == 3
    spark.range(2).createOrReplaceTempView("named")
    assert T.read_table(spark, "named").count() == 2


def test_connector_options():
    assert T.kafka_options("h:1", "a, b,", startingOffsets="latest") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "latest",
    }
    assert T.kafka_options("h:1", ["a", "b"])["subscribe"] == "a,b"
    options = sinks.jdbc_options("jdbc:x", "t", 500, user="u")
    assert options == {"url": "jdbc:x", "dbtable": "t", "batchsize": "500", "user": "u"}


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    sinks.append(df, path)
    sinks.append(df, path)
    assert spark.read.parquet(path).count() == 4
    sinks.overwrite(df, path)
    assert spark.read.parquet(path).count() == 2
    by_key = str(tmp_path / "p")
    sinks.overwrite_partitions(df, by_key, ["k"])
    sinks.overwrite_partitions(spark.createDataFrame([("b", 9), ("b", 8)], df.schema), by_key, ["k"])
    assert pairs(spark.read.parquet(by_key), "k", "v") == [("a", 1), ("b", 8), ("b", 9)]


class SessionWith:
    """As much of a session as choosing a folder looks at."""

    def __init__(self, master, **settings):
        self.conf, self.sparkContext, self.master = settings, self, master


def test_shared_folder_follows_the_session(spark):
    cluster = SessionWith("yarn", **{"spark.checkpoint.dir": "hdfs://x/cp/"})
    assert shared_folder(cluster).startswith("hdfs://x/cp/trailmark-")
    assert shared_folder(cluster) != shared_folder(cluster)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SessionWith("yarn"))
    assert "trailmark-" in shared_folder(SessionWith("local[2]"))
    assert written(spark.range(4), shared_folder(spark), "x").count() == 4
