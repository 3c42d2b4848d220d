from __future__ import annotations

import random

import pytest

from fixtures import actions, pairs
from trailmark.operators import pages

STEPS = ("step", "from_page", "to_page", "pair_count", "convert_rate")


def visits(spark, **sessions):
    return actions(
        spark,
        *[
            {"session_id": s, "page_id": p, "at": i * 10}
            for s, path in sessions.items()
            for i, p in enumerate(path)
        ],
    )


def test_rates_along_the_flow(spark):
    log = visits(spark, a=[1, 2, 3], b=[1, 2, 9, 3], c=[1, 1, 2], d=[2, 3])
    got = pairs(pages.page_conversion(log, [1, 2, 3]), *STEPS)
    assert got == [(1, 1, 2, 3, 0.75), (2, 2, 3, 2, 0.67)]


def test_step_nobody_takes_and_unseen_start(spark):
    log = visits(spark, a=[1, 2], b=[3, 4])
    got = pages.page_conversion(log, [1, 2, 3, 4]).orderBy("step").collect()
    assert [(r.pair_count, r.convert_rate) for r in got] == [(1, 1.0), (0, 0.0), (1, None)]
    got = pages.page_conversion(log, [7, 1]).collect()
    assert [(r.pair_count, r.convert_rate) for r in got] == [(0, None)]


def test_flow_with_a_repeated_pair(spark):
    log = visits(spark, a=[1, 2, 1, 2])
    got = pairs(pages.page_conversion(log, [1, 2, 1, 2]), *STEPS)
    assert got == [(1, 1, 2, 2, 1.0), (2, 2, 1, 1, 0.5), (3, 1, 2, 2, 2.0)]


def test_flow_from_a_page_to_itself(spark):
    got = pairs(pages.page_conversion(visits(spark, a=[1, 1, 1, 2]), [1, 1, 2]), *STEPS)
    assert got == [(1, 1, 1, 2, 0.67), (2, 1, 2, 1, 0.5)]


def test_equal_times_follow_the_tie_breaker(spark):
    log = actions(
        spark,
        {"page_id": 2, "event_id": 2},
        {"page_id": 1, "event_id": 1},
    )
    assert pairs(pages.page_pair_counts(log, [1, 2], ["event_id"]), "pair_count") == [(1,)]
    assert pages.page_pair_counts(log, [2, 1], ["event_id"]).count() == 0


def test_flow_needs_two_pages(spark):
    with pytest.raises(ValueError):
        pages.page_conversion(visits(spark, a=[1]), [1])


def test_text_keeps_the_order_of_the_flow(spark):
    log = visits(spark, a=[1, 2, 3], b=[1, 2])
    conversion = pages.page_conversion(log, [1, 2, 3, 4, 5])
    assert pages.conversion_text(conversion).first().convert_rate == "1_2=1.0|2_3=0.5|3_4=0.0|4_5=null"


def test_sessions_cut_into_ranges_count_the_same(spark):
    rng = random.Random(7)
    paths = {f"s{i}": [rng.randint(1, 4) for _ in range(rng.randint(1, 12))] for i in range(40)}
    paths["hot"] = [rng.randint(1, 4) for _ in range(400)]
    # several actions share a second
    log = actions(
        spark,
        *[
            {"session_id": s, "page_id": p, "at": i // 3}
            for s, path in paths.items()
            for i, p in enumerate(path)
        ],
    ).repartition(8)
    flow = [1, 2, 3, 3, 4, 1]
    wanted = {}
    for path in paths.values():
        for pair in zip(path, path[1:]):
            wanted[pair] = wanted.get(pair, 0) + 1
    want = sorted((a, b, wanted[a, b]) for a, b in set(zip(flow, flow[1:])))
    columns = ("from_page", "to_page", "pair_count")
    for hot_rows in (None, 10**6, 200, 5, 1):
        got = pairs(pages.page_pair_counts(log, flow, ["event_id"], hot_rows), *columns)
        assert got == want, hot_rows
    starts = sum(path.count(1) for path in paths.values())
    for hot_rows in (None, 5):
        first = pages.page_conversion(log, flow, ["event_id"], hot_rows).where("step = 1").first()
        assert first.convert_rate == int((200 * first.pair_count + starts) // (2 * starts)) / 100
