from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fixtures import clicks, pairs
from trailmark.operators import ads


def t(day, hour=0, minute=0, second=0):
    return datetime(2024, 1, day, hour, minute, second)


def test_parse_and_reject_lines(spark):
    good = ["1704067199999 P C 5 6", "1704067200000 P C 5 6 more"]
    bad = ["1704067200000 P C 5", "1704067200000 P C five 6", "soon P C 5 6", ""]
    lines = spark.createDataFrame([(v,) for v in good + bad], "value string")
    parsed = ads.parse_ad_log(lines)
    assert parsed.columns == ["ts", "province", "city", "user_id", "ad_id"]
    assert pairs(parsed.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), "user_id", "ad_id"), "*") == [
        ("2023-12-31 23:59:59.999", 5, 6),
        ("2024-01-01 00:00:00.000", 5, 6),
    ]
    assert pairs(ads.ad_log_rejects(lines), "value") == sorted((v,) for v in bad)


def test_daily_blacklist(spark):
    rows = [(t(1), "p", "c", 1, 1)] * 3 + [(t(1), "p", "c", 2, 1)] * 2 + [(t(1), "p", "c", 2, 2)] * 2
    rows += [(t(2), "p", "c", 1, 1)] * 4 + [(t(2, 23, 59, 59), "p", "c", 3, 1)] * 2 + [(t(3), "p", "c", 3, 1)]
    df = clicks(spark, *rows)
    black = ads.daily_blacklist(df, 3)
    assert pairs(black, "user_id", "flagged_date") == [(1, "2024-01-01")]
    kept = ads.clicks_until_flagged(df, black)
    assert kept.columns == df.columns
    assert pairs(kept.groupBy("user_id").count(), "user_id", "count") == [(1, 3), (2, 4), (3, 3)]
    assert ads.daily_blacklist(df).count() == 0


def test_province_top_is_per_day(spark):
    rows = []
    for day, ad, n in ((1, 1, 5), (1, 2, 4), (1, 3, 4), (1, 4, 4), (2, 4, 1), (2, 1, 2)):
        rows += [(t(day), "p", f"c{i % 2}", 9, ad) for i in range(n)]
    stat = ads.ad_stat(clicks(spark, *rows))
    assert pairs(ads.province_top_ads(stat), "date", "province", "ad_id", "click_count") == [
        ("2024-01-01", "p", 1, 5),
        ("2024-01-01", "p", 2, 4),
        ("2024-01-01", "p", 3, 4),
        ("2024-01-02", "p", 1, 2),
        ("2024-01-02", "p", 4, 1),
    ]


def test_last_hour_of_minutes(spark):
    rows = [(t(1, 10, m, 59), "p", "c", 1, 1) for m in range(60)] + [(t(1, 11, 5, 1), "p", "c", 1, 2)] * 2
    log = clicks(spark, *rows)
    trend = ads.click_trend(ads.minute_clicks(ads.last_minutes(log)))
    got = pairs(trend, "date", "hour", "minute", "ad_id", "click_count")
    assert len(got) == 55
    assert got[0] == ("2024-01-01", "10", "06", 1, 1) and got[-1] == ("2024-01-01", "11", "05", 2, 2)
    counts = ads.minute_clicks(log)
    assert ads.last_minutes(counts, 10, time="minute_start").count() == 5
    until = ads.last_minutes(counts, 10, F.lit(t(1, 10, 9, 30)), "minute_start")
    assert until.count() == 10
