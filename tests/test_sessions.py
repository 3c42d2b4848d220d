from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import START, actions, pairs, users
from trailmark.functions import STEP_BUCKETS, VISIT_BUCKETS
from trailmark.operators import sampling, sessions
from trailmark.operators.metrics import Metrics
from trailmark.params import TaskParams


def aggregate(spark, *rows, people=()):
    return sessions.session_aggregate(actions(spark, *rows), users(spark, *people))


def test_lists_are_sets_of_whole_values_in_order(spark):
    row = aggregate(
        spark,
        {"click_category_id": 11, "search_keyword": "bb"},
        {"click_category_id": 1, "search_keyword": "b"},
        {"click_category_id": 2},
        {"click_category_id": 11, "search_keyword": "", "at": 90},
        {"search_keyword": "b"},
    ).first()
    assert row.click_category_ids == [1, 2, 11]
    assert row.search_keywords == ["b", "bb"]
    assert (row.visit_length, row.step_length, row.start_time) == (90, 5, START)
    assert (row.user_id, row.age, row.professional, row.city, row.sex) == (1, 30, "p1", "c1", "male")


def test_session_without_clicks_and_unknown_user(spark):
    df = aggregate(spark, {"session_id": "a"}, {"session_id": "b", "user_id": 9})
    row = df.collect()
    assert len(row) == 1 and row[0].click_category_ids == [] and row[0].visit_length == 0
    log = actions(spark, {"user_id": 1}, {"user_id": 9}, {"user_id": 9})
    assert sessions.unmatched(log, users(spark), "user_id").first().unmatched == 2


PEOPLE = (
    (1, "u", "n", 20, "p1", "c1", "male"),
    (2, "u", "n", 40, "p2", "c2", "female"),
    (3, "u", "n", None, None, None, None),
)


@pytest.mark.parametrize(
    ("params", "want"),
    [
        ({}, "abc"),
        ({"startAge": 30}, "abc"),
        ({"endAge": 30}, "abc"),
        ({"startAge": 20, "endAge": 40}, "ab"),
        ({"startAge": 21, "endAge": 40}, "b"),
        ({"professionals": "p1,p9"}, "a"),
        ({"cities": "c2"}, "b"),
        ({"sex": "male,female"}, "ab"),
        ({"keywords": "kw1"}, "b"),
        ({"keywords": ""}, "abc"),
        ({"categoryIds": "1"}, "b"),
        ({"categoryIds": "1,11"}, "ab"),
        ({"categoryIds": "1,11", "sex": "male"}, "a"),
    ],
)
def test_filters(spark, params, want):
    df = aggregate(
        spark,
        {"session_id": "a", "user_id": 1, "click_category_id": 11, "search_keyword": "kw11"},
        {"session_id": "b", "user_id": 2, "click_category_id": 1, "search_keyword": "kw1"},
        {"session_id": "c", "user_id": 3},
        people=PEOPLE,
    )
    kept = sessions.filter_sessions(df, TaskParams.parse(params))
    assert "".join(r[0] for r in pairs(kept, "session_id")) == want


def test_bucket_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800]
    steps = [1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60]
    n = len(lengths) + len(steps)
    df = spark.createDataFrame(
        [(v, 0) for v in lengths] + [(0, s) for s in steps], "visit_length long, step_length long"
    )
    row = sessions.session_stats(df).first()
    assert row.session_count == n

    def share(k):
        return int((200 * k + n) // (2 * n)) / 100

    for name, *_ in VISIT_BUCKETS:
        assert row[f"visit_length_{name}_ratio"] == share(1 if name == "30m" else 2), name
    for name, *_ in STEP_BUCKETS:
        assert row[f"step_length_{name}_ratio"] == share(1 if name == "60" else 2), name


def test_stats_of_nothing(spark):
    df = spark.createDataFrame([], "visit_length long, step_length long")
    row = sessions.session_stats(df).first()
    assert row.session_count == 0 and row.visit_length_30m_ratio is None


def test_details_and_hour_share(spark):
    log = actions(spark, {"session_id": "a"}, {"session_id": "b", "at": 3600}, {"session_id": "b", "at": 3700})
    some = sessions.session_aggregate(log, users(spark))
    only_b = some.where("session_id = 'b'")
    assert pairs(sessions.session_details(log, only_b), "session_id") == [("b",), ("b",)]
    share = sessions.session_hour_share(some)
    assert pairs(share, "date", "hour", "session_count", "share") == [
        ("2024-01-01", "08", 1, 0.5),
        ("2024-01-01", "09", 1, 0.5),
    ]


def hours(spark, counts):
    """Sessions per (day, hour)."""
    rows = [
        (f"{day}-{hour}-{i}", datetime(2024, 1, 1) + timedelta(days=day, hours=hour), ["w"], [1])
        for (day, hour), n in counts.items()
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "session_id string, start_time timestamp, search_keywords array<string>,"
        " click_category_ids array<long>",
    )


def sampled_per_hour(df, **kwargs):
    sample = sampling.sample_sessions(df, **kwargs)
    ids = [r.session_id for r in sample.collect()]
    assert len(ids) == len(set(ids))
    per = {}
    for i in ids:
        day, hour, _ = i.split("-")
        per[int(day), int(hour)] = per.get((int(day), int(hour)), 0) + 1
    return per


def test_sample_quotas(spark):
    # two days, so 50 a day: 29/100*50 = 14, 71/100*50 = 35; a small day is taken whole
    df = hours(spark, {(0, 1): 29, (0, 2): 71, (1, 5): 3})
    assert sampled_per_hour(df) == {(0, 1): 14, (0, 2): 35, (1, 5): 3}


def test_sample_quota_is_whole_number_arithmetic(spark):
    assert sampled_per_hour(hours(spark, {(0, 1): 29, (0, 2): 71})) == {(0, 1): 29, (0, 2): 71}
    assert sampled_per_hour(hours(spark, {(0, 1): 29, (0, 2): 171})) == {(0, 1): 14, (0, 2): 85}


def test_sample_of_more_days_than_total_is_empty(spark):
    assert sampled_per_hour(hours(spark, {(d, 0): 2 for d in range(101)})) == {}


def test_sample_takes_the_smallest_draws(spark):
    df = hours(spark, {(0, 1): 5000, (0, 2): 300})
    want = set()
    for hour, quota in ((1, 943), (2, 56)):
        drawn = df.where(F.hour("start_time") == hour).withColumn(
            "draw", F.md5(F.concat(F.lit("x"), F.col("session_id")))
        )
        want |= {r.session_id for r in drawn.orderBy("draw", "session_id").limit(quota).collect()}
    got = {r.session_id for r in sampling.sample_sessions(df, 1000, "x").collect()}
    assert got == want
    assert got != {r.session_id for r in sampling.sample_sessions(df, 1000, "y").collect()}


def test_sample_details(spark):
    log = actions(spark, {"session_id": "a"}, {"session_id": "a", "at": 5}, {"session_id": "b"})
    sample = spark.createDataFrame([("a",)], "session_id string")
    assert sampling.sample_details(sample, log).count() == 2


def test_aggregate_and_stats_against_plain_python(spark):
    rng = random.Random(3)
    rows = [
        {
            "session_id": f"s{rng.randint(0, 60)}",
            "user_id": 1,
            "at": rng.choice([0, 1, 2, 5, 8, 20, 45, 100, 400, 1000, 4000]),
            "search_keyword": rng.choice([None, "", "a", "ab", "b"]),
            "click_category_id": rng.choice([None, 1, 11, 2]),
        }
        for _ in range(600)
    ]
    want = {}
    for row in rows:
        words, ids, times = want.setdefault(row["session_id"], (set(), set(), []))
        words.add(row["search_keyword"] or None)
        ids.add(row["click_category_id"])
        times.append(row["at"])
    df = aggregate(spark, *rows)
    got = {r.session_id: r for r in df.collect()}
    assert got.keys() == want.keys()
    for name, (words, ids, times) in want.items():
        row = got[name]
        assert row.search_keywords == sorted(w for w in words if w)
        assert row.click_category_ids == sorted(i for i in ids if i is not None)
        assert row.step_length == len(times) and row.visit_length == max(times) - min(times)
    stats, n = sessions.session_stats(df).first(), len(want)
    assert stats.session_count == n
    for buckets, column, values in (
        (VISIT_BUCKETS, "visit_length", [max(t) - min(t) for _, _, t in want.values()]),
        (STEP_BUCKETS, "step_length", [len(t) for _, _, t in want.values()]),
    ):
        for name, low, high in buckets:
            k = sum(1 for v in values if v >= low and (high is None or v < high))
            assert stats[f"{column}_{name}_ratio"] == (200 * k + n) // (2 * n) / 100


@pytest.mark.parametrize("params", [{}, {"keywords": "kw1"}, {"categoryIds": "3,9"}, {"keywords": "kw1,kw2", "categoryIds": "3"}, {"startAge": 21, "endAge": 40, "keywords": "kw2"}, {"sex": "male"}, {"keywords": ""}, {"categoryIds": ""}])
def test_summary_passes_what_the_lists_pass(spark, params):
    r = random.Random(4)
    words, cats = [None, "", "kw1", "kw2", "kw11"], [None, 3, 9, 33]
    log = [
        {"session_id": f"s{r.randrange(12)}", "user_id": 1, "at": r.randrange(99), "search_keyword": r.choice(words), "click_category_id": r.choice(cats)}
        for _ in range(40)
    ]
    log = [dict(x, user_id=1 + int(x["session_id"][1:]) % 4) for x in log]
    params = TaskParams.parse(params)
    listed = sessions.filter_sessions(sessions.session_aggregate(actions(spark, *log), users(spark, *PEOPLE)), params)
    for metrics in (None, Metrics()):
        summary = sessions.session_summary(actions(spark, *log), users(spark, *PEOPLE), params, metrics)
        assert pairs(summary, *summary.columns) == pairs(listed, *summary.columns)
    sessions_of = {x["session_id"] for x in log if x["user_id"] == 4}
    assert metrics.values() == {"unmatched_sessions": len(sessions_of)}


def test_values_and_lists_say_the_same(spark):
    log = actions(spark, {"click_category_id": 11, "search_keyword": "b"}, {"click_category_id": 11}, {"search_keyword": "a"}, {"search_keyword": ""}, {"session_id": "t"})
    values = sessions.session_values(log)
    assert pairs(values, "*") == [("s", "category", "11"), ("s", "keyword", "a"), ("s", "keyword", "b")]
    listed = sessions.with_lists(sessions.session_summary(log, users(spark)), log)
    assert pairs(listed, "session_id", "search_keywords", "click_category_ids") == [("s", ["a", "b"], [11]), ("t", [], [])]


def test_a_session_of_very_many_words_takes_one_row(spark):
    """Two million different words in one session; nothing that grows with them is kept."""
    many = spark.range(0, 2_000_000, 1, 8).select(
        F.lit("bot").alias("session_id"),
        F.lit(1).cast("long").alias("user_id"),
        F.concat(F.lit("w"), "id").alias("search_keyword"),
        F.col("id").alias("click_category_id"),
        F.timestamp_seconds(F.col("id") % 3600).alias("action_time"),
    )
    params = TaskParams.parse({"keywords": "none,w1999999", "categoryIds": "77"})
    summary = sessions.session_summary(many, users(spark), params)
    text = summary._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text
    row = summary.first()
    assert (row.session_id, row.step_length, row.visit_length) == ("bot", 2_000_000, 3599)
    assert sessions.session_summary(many, users(spark), TaskParams.parse({"keywords": "none"})).isEmpty()
    assert sessions.session_values(many.limit(1000)).count() == 2000
