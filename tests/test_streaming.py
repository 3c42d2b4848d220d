from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import clicks, pairs
from trailmark import schemas
from trailmark.operators import ads
from trailmark.plans.jobs import AdTables, ad_job
from trailmark.sources.tables import file_lines
from trailmark.streaming import blacklist as B
from trailmark.streaming import counts, files
from trailmark.streaming.tables import BatchTable, CountTable, GrowingSet

DAY = datetime(2024, 1, 1)
CLICK = tuple(schemas.CLICKS.names)


def rows(day, user, ad, n, province="p", city="c", start=0):
    at = DAY + timedelta(days=day, minutes=start)
    return [(at + timedelta(seconds=i), province, city, user, ad) for i in range(n)]


def line(row):
    ts, province, city, user, ad = row
    return f"{int((ts - datetime(1970, 1, 1)).total_seconds() * 1000)} {province} {city} {user} {ad}"


def put(folder, name, batch):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line(r) + "\n" for r in batch))


BATCHES = [
    rows(0, 1, 1, 2) + rows(0, 2, 1, 1) + rows(0, 3, 5, 1),
    rows(0, 1, 1, 1) + rows(0, 2, 2, 2),  # user 1 reaches 3 on ad 1
    rows(0, 1, 4, 5) + rows(0, 2, 2, 1) + rows(1, 3, 5, 2),  # user 1 is dropped, user 2 reaches 3
    rows(1, 2, 7, 1) + rows(1, 3, 5, 1) + rows(1, 1, 1, 1),  # only user 3 remains, and reaches 3
]
LISTED = [(1,), (2,), (3,)]
COUNTS = [
    ("2024-01-01", 1, 1, 3),
    ("2024-01-01", 2, 1, 1),
    ("2024-01-01", 2, 2, 3),
    ("2024-01-01", 3, 5, 1),
    ("2024-01-02", 3, 5, 3),
]


def check(tables):
    assert pairs(tables.blacklist.read(), "user_id") == LISTED
    current = tables.user_clicks.current()
    assert pairs(current, *schemas.AD_USER_CLICK_COUNT.names) == COUNTS
    assert tables.clicks.read().count() == sum(c[-1] for c in COUNTS)


def test_blacklist_batches_and_their_replay(spark, tmp_path):
    tables = B.BlacklistTables.at(spark, str(tmp_path))
    for i, batch in enumerate(BATCHES):
        B.process_batch(clicks(spark, *batch), i, tables, threshold=3)
    check(tables)
    # any batch may run again after a failure
    for i in (3, 1):
        B.process_batch(clicks(spark, *BATCHES[i]), i, tables, threshold=3)
        check(tables)
    assert pairs(tables.blacklist.read(), "batch_id", "user_id") == [(1, 1), (2, 2), (3, 3)]


def test_folding_changes_nothing(spark, tmp_path):
    tables = B.BlacklistTables.at(spark, str(tmp_path))
    folding = replace(tables, user_clicks=replace(tables.user_clicks, fold_every=2))
    for i, batch in enumerate(BATCHES):
        B.process_batch(clicks(spark, *batch), i, folding, threshold=3)
        B.process_batch(clicks(spark, *batch), i, folding, threshold=3)  # as after a failure
    check(tables)
    # batch 2 folded as of batch 1 what there was before it
    assert pairs(tables.user_clicks.rows().select("date", "batch_id").distinct(), "*") == [
        ("2024-01-01", 1),
        ("2024-01-01", 2),
        ("2024-01-02", 2),
        ("2024-01-02", 3),
    ]
    tables.user_clicks.fold(3)
    check(tables)
    # what batches 2 and 3 did not touch is as the fold before left it
    assert pairs(tables.user_clicks.rows().select("date", "user_id", "batch_id").distinct(), "*") == [
        ("2024-01-01", 1, 1),
        ("2024-01-01", 2, 3),
        ("2024-01-01", 3, 1),
        ("2024-01-02", 3, 3),
    ]


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_folds_keep_the_files_of_the_one_before(spark, tmp_path):
    stat = CountTable(spark, str(tmp_path), schemas.AD_STAT, fold_every=3)
    seen = []
    for i in range(11):
        stat.write(ads.ad_stat(clicks(spark, *rows(0, 1, 1, 1))), i)
        assert stat.current().first().click_count == i + 1
        places = [tmp_path / "batches", tmp_path / "folds" / "date=2024-01-01"]
        seen.append([folders(place) for place in places if place.exists()])
    # after the folds of batches 0-2, 0-5 and 0-8: a reader of the state before a fold finds its files
    assert seen[3] == [[f"batch_id={k}" for k in range(4)], ["batch_id=2"]]
    assert seen[6] == [[f"batch_id={k}" for k in range(3, 7)], ["batch_id=2", "batch_id=5"]]
    assert seen[9] == [[f"batch_id={k}" for k in range(6, 10)], ["batch_id=5", "batch_id=8"]]
    assert len(seen[10][0]) + len(seen[10][1]) <= 2 * 3 + 2


def test_a_batch_writes_few_files(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path), schemas.AD_BLACKLIST)
    table.write(spark.range(100).withColumnRenamed("id", "user_id").repartition(40), 0)
    assert len(list((tmp_path / "batch_id=0").glob("*.parquet"))) == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_folds_are_chosen_without_a_join(spark, tmp_path):
    stat = CountTable(spark, str(tmp_path), schemas.AD_STAT, fold_every=2)
    for i in range(4):
        stat.write(ads.ad_stat(clicks(spark, *rows(i % 2, 1, 1, 1))), i)
    text = plan(stat.rows())
    assert "Join" not in text and "batch_id" in text.split("PartitionFilters: [")[1]


def test_a_date_touched_now_and_then_is_folded(spark, tmp_path):
    stat = CountTable(spark, str(tmp_path), schemas.AD_STAT, fold_every=5)
    for i in range(16):
        # the quiet date has rows in all batches but those that fold
        days = (0,) if i % 5 == 0 else (0, 7)
        stat.write(ads.ad_stat(clicks(spark, *[r for d in days for r in rows(d, 1, 1, 1)])), i)
    assert pairs(stat.current(), "date", "click_count") == [("2024-01-01", 16), ("2024-01-08", 12)]
    assert folders(tmp_path / "folds" / "date=2024-01-08") == ["batch_id=14", "batch_id=9"]
    assert folders(tmp_path / "batches") == [f"batch_id={k}" for k in range(10, 16)]
    # the state before the last fold can still be read
    assert pairs(stat.current(12), "date", "click_count") == [("2024-01-01", 13), ("2024-01-08", 10)]


def test_a_batch_reads_the_buckets_of_its_users(spark, tmp_path):
    tables = B.BlacklistTables.at(spark, str(tmp_path))
    everyone = [r for user in range(60) for r in rows(0, user, 1, 1)]
    B.process_batch(clicks(spark, *everyone), 0, tables, threshold=3)
    many = tables.user_clicks.write(ads.user_daily_clicks(clicks(spark, *everyone)), 1)
    tables.user_clicks.write(ads.user_daily_clicks(clicks(spark, *rows(0, 8, 1, 1))), 2)
    tables.user_clicks.fold(1)
    parts = tables.user_clicks.write(ads.user_daily_clicks(clicks(spark, *rows(0, 7, 1, 1))), 3)
    assert len(many) > 10 and len(parts) == 1 and parts[0][0] == "2024-01-01"
    found = B.newly_listed(tables, 3, parts, 3)
    assert pairs(found, "user_id") == [(7,)]
    scans = [x.split("\n")[0] for x in plan(found).split("FileScan")[1:] if "/folds" in x or "bucket" in x]
    assert any("bucket" in x.split("PartitionFilters: [")[1].split("PushedFilters")[0] for x in scans)
    # one bucket of the fold and one of the batches since then; no other is even listed
    files = sorted(f.split("ad_user_click_count/")[1].rsplit("/", 1)[0] for f in tables.user_clicks.rows(3, parts).inputFiles())
    assert files == ["batches/batch_id=3", f"folds/date=2024-01-01/bucket={parts[0][1]}/batch_id=1"]


def test_blacklist_is_a_snapshot_and_a_short_tail(spark, tmp_path):
    listed = GrowingSet(spark, str(tmp_path), schemas.AD_BLACKLIST, fold_every=4)
    seen = []
    for i in range(21):
        users = spark.range(i, i + 1).withColumnRenamed("id", "user_id")
        listed.write(users, i)
        listed.write(users, i)  # as after a failure
        assert [r.user_id for r in listed.before(i + 1).orderBy("user_id").collect()] == list(range(i + 1))
        assert listed.before(i).count() == i and listed.before(i // 2).count() == i // 2
        seen.append(len(folders(tmp_path / "tail")) + len(folders(tmp_path / "snapshots") if i >= 4 else []))
    assert listed.version() == 19 and folders(tmp_path / "snapshots") == ["upto=15", "upto=19"]
    assert max(seen[12:]) <= max(seen[:12]) and len(listed.read().inputFiles()) <= 2 + 4
    assert pairs(listed.read(), "user_id", "batch_id") == [(i, i) for i in range(21)]
    listed.fold(3)  # older than the snapshot
    assert listed.version() == 19


def test_a_reader_between_snapshot_and_pointer_sees_all_rows(spark, tmp_path, monkeypatch):
    listed = GrowingSet(spark, str(tmp_path), schemas.AD_BLACKLIST, fold_every=2)
    users = spark.range(3).withColumnRenamed("id", "user_id")

    def lost(*_):
        raise OSError("executor lost")

    listed.write(users, 0)
    listed.write(users.limit(0), 1)
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(files, "replace_text", lost)
        listed.fold(1)
    assert listed.version() == -1 and listed.read().count() == 3
    listed.fold(1)
    assert listed.version() == 1 and pairs(listed.read(), "user_id") == [(0,), (1,), (2,)]


def test_province_top_reads_the_provinces_of_the_batch(spark, tmp_path):
    top = counts.ProvinceTop.at(spark, str(tmp_path))
    stat = CountTable(spark, str(tmp_path / "stat"), schemas.AD_STAT)
    provinces = [f"p{k}" for k in range(12)]
    first = [r for k, p in enumerate(provinces) for r in rows(0, 1, k, 2, p)]
    counts.add_stat(clicks(spark, *first), 0, stat, top)
    second = rows(0, 1, 9, 3, "p3") + rows(0, 1, 8, 1, "p3")
    counts.add_stat(clicks(spark, *second), 1, stat, top)
    counts.add_stat(clicks(spark, *second), 1, stat, top)  # as after a failure
    want = ads.province_top_ads(ads.ad_stat(clicks(spark, *first, *second)))
    columns = schemas.AD_PROVINCE_TOP3.names
    assert pairs(top.read(), *columns) == pairs(want, *columns)
    top.totals.fold(0)
    counts.add_stat(clicks(spark, *rows(0, 1, 9, 3, "p4")), 2, stat, top)
    touched = top.totals._notes()[2]
    assert len(touched) == 1
    used = top.totals.rows(2, touched).inputFiles()
    assert [f"/bucket={touched[0][1]}/" in f for f in used if "/folds/" in f] == [True]
    assert len(used) < len(top.totals.rows(2).inputFiles())


def test_last_hour_opens_two_hours(spark, tmp_path):
    trend = counts.trend_table(spark, str(tmp_path))
    counts.add_trend(clicks(spark, *[r for h in range(20) for r in rows(0, 1, 1, 1, start=60 * h + 4)]), 0, trend)
    trend.fold(0)
    counts.add_trend(clicks(spark, *rows(0, 1, 1, 1, start=60 * 9)), 1, trend)
    at = DAY + timedelta(hours=13, minutes=5)
    hour = counts.last_hour(trend, until=at)
    assert pairs(hour, "hour", "minute") == [("13", "04")]
    opened = {f.split("/hour=")[1][:2] for f in hour.inputFiles()}
    assert opened == {"12", "13"}
    # over midnight: one hour of each day
    counts.add_trend(clicks(spark, *[r for h in range(48) for r in rows(0, 1, 1, 1, start=60 * h + 4)]), 2, trend)
    trend.fold(2)
    night = counts.last_hour(trend, until=DAY + timedelta(days=1, minutes=5))
    opened = {f.split("/date=")[1].split("/batch")[0] for f in night.inputFiles()}
    assert opened == {"2024-01-01/hour=23", "2024-01-02/hour=00"}
    assert pairs(night, "date", "click_count") == [("2024-01-02", 1)]


def test_small_files(spark, tmp_path):
    path = f"{tmp_path}/a/b"
    assert files.read_text(spark, path) is None and files.listed(spark, f"{tmp_path}/a/*") == "[]"
    for text in ("1", "ünï\n2", ""):
        files.replace_text(spark, path, text)
        assert files.read_text(spark, path) == text
    assert files.listed(spark, f"{tmp_path}/a/*").endswith("/a/b]")
    files.remove(spark, [path, path])
    assert files.read_text(spark, path) is None


def test_blacklist_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    tables = B.BlacklistTables.at(spark, str(tmp_path / "tables"))
    for i, batch in enumerate(BATCHES):
        put(tmp_path / "in", f"{i}.txt", batch)
        (tmp_path / "in" / f"junk{i}.txt").write_text("no click\n")
        B.blacklist_stream(
            file_lines(spark, str(tmp_path / "in")), tables, str(tmp_path / "cp"), 3, B.ALL_AVAILABLE
        ).awaitTermination()
    check(tables)


def click_stream(spark, folder):
    return ads.parse_ad_log(file_lines(spark, str(folder)))


def test_stat_and_province_top_over_several_runs(spark, tmp_path):
    stat = CountTable(spark, str(tmp_path / "stat"), schemas.AD_STAT, fold_every=3)
    top = counts.ProvinceTop.at(spark, str(tmp_path / "top"))
    batches = [
        rows(0, 1, 1, 2) + rows(0, 1, 2, 3, "q"),
        rows(0, 1, 1, 1, city="d") + rows(0, 1, 3, 1) + rows(0, 5, 4, 1) + rows(0, 5, 5, 2),
        rows(0, 2, 1, 1) + rows(1, 2, 3, 1),
    ]
    for i, batch in enumerate(batches):
        put(tmp_path / "in", f"{i}.txt", batch)
        counts.ad_stat_stream(
            click_stream(spark, tmp_path / "in"),
            stat,
            str(tmp_path / "cp"),
            top,
            trigger=B.ALL_AVAILABLE,
        ).awaitTermination()
        everything = ads.ad_stat(clicks(spark, *[r for b in batches[: i + 1] for r in b]))
        columns = schemas.AD_STAT.names
        assert pairs(stat.current(), *columns) == pairs(everything, *columns)
        columns = schemas.AD_PROVINCE_TOP3.names
        assert pairs(top.read(), *columns) == pairs(ads.province_top_ads(everything), *columns)
    stat.fold(10)
    assert pairs(stat.current(), *schemas.AD_STAT.names) == pairs(everything, *schemas.AD_STAT.names)


def test_trend_counts_late_clicks(spark, tmp_path):
    trend = counts.trend_table(spark, str(tmp_path / "trend"))
    first = rows(0, 1, 1, 2) + rows(0, 1, 1, 1, start=50)
    second = rows(0, 1, 1, 3) + rows(0, 1, 2, 1, start=130)
    third = rows(0, 1, 1, 4) + rows(-10, 1, 1, 1)  # 130 minutes and ten days behind
    for i, batch in enumerate((first, second, third)):
        put(tmp_path / "in", f"{i}.txt", batch)
        counts.click_trend_stream(
            click_stream(spark, tmp_path / "in"), trend, str(tmp_path / "cp"), trigger=B.ALL_AVAILABLE
        ).awaitTermination()
    assert pairs(trend.current(), *schemas.AD_CLICK_TREND.names) == [
        ("2023-12-22", "00", "00", 1, 1),
        ("2024-01-01", "00", "00", 1, 9),
        ("2024-01-01", "00", "50", 1, 1),
        ("2024-01-01", "02", "10", 2, 1),
    ]
    at = DAY + timedelta(minutes=130, seconds=20)
    assert pairs(counts.last_hour(trend, until=at), "hour", "minute") == [("02", "10")]
    assert counts.last_hour(trend, 81, at).count() == 2
    # the clock decides, not the newest row
    add = rows(27_393, 1, 1, 1) + [(datetime(9999, 12, 31, 23, 59), "p", "c", 1, 1)]
    counts.add_trend(clicks(spark, *add), 9, trend)
    assert pairs(counts.last_hour(trend, until=at), "hour", "minute") == [("02", "10")]
    assert pairs(counts.last_hour(trend, until=DAY + timedelta(minutes=60)), "minute") == [("50",)]
    assert counts.last_hour(trend).isEmpty()


def test_lines_of_any_number_do_not_stop_the_stream(spark, tmp_path):
    tables = B.BlacklistTables.at(spark, str(tmp_path / "tables"))
    odd = ["9223372036854775807", "-9223372036854775808", "253402300800000", "-62135596800001", "1e9", ""]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("".join(f"{x} p c 1 2\n" for x in [*odd, "253402300799999"]))
    for _ in range(2):
        B.blacklist_stream(
            file_lines(spark, str(tmp_path / "in")), tables, str(tmp_path / "cp"), 3, B.ALL_AVAILABLE
        ).awaitTermination()
    assert pairs(tables.clicks.read().select(F.year("ts").alias("y")), "y") == [(9999,)]
    assert sorted(r.value for r in tables.rejects.batch(0).collect()) == sorted(f"{x} p c 1 2" for x in odd)


def test_ad_job_counts_what_the_blacklist_lets_through(spark, tmp_path):
    tables = AdTables.at(spark, str(tmp_path / "tables"))
    for i, batch in enumerate(BATCHES):
        put(tmp_path / "in", f"{i}.txt", batch)
        lines = file_lines(spark, str(tmp_path / "in"))
        ad_job(lines, tables, str(tmp_path / "cp"), 3, B.ALL_AVAILABLE).awaitTermination()
    check(tables.blacklist)
    kept = tables.blacklist.clicks.read().select(*CLICK)
    columns = schemas.AD_STAT.names
    assert pairs(tables.stat.current(), *columns) == pairs(ads.ad_stat(kept), *columns)
    columns = schemas.AD_CLICK_TREND.names
    want = ads.click_trend(ads.minute_clicks(kept))
    assert pairs(tables.trend.current(), *columns) == pairs(want, *columns)
    columns = schemas.AD_PROVINCE_TOP3.names
    assert pairs(tables.top.read(), *columns) == pairs(ads.province_top_ads(ads.ad_stat(kept)), *columns)


def test_table_that_does_not_exist_yet_is_empty(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "none"), schemas.AD_BLACKLIST)
    assert table.read().isEmpty() and not table.has(0)
    count = CountTable(spark, str(tmp_path / "none2"), schemas.AD_STAT)
    assert count.current().isEmpty()
    with pytest.raises(Exception, match="clash"):
        table.write(spark.range(1).select(F.raise_error(F.lit("clash")).cast("long").alias("user_id")), 0)


def test_lines_rejects_and_late_clicks_are_counted(spark, tmp_path):
    tables = B.BlacklistTables.at(spark, str(tmp_path / "tables"))
    batches = [rows(0, 1, 1, 2), [], rows(0, 2, 1, 2, start=61) + rows(0, 3, 1, 1, start=1), rows(0, 4, 1, 1) + rows(0, 5, 1, 1, start=2)]
    for i, batch in enumerate(batches):
        put(tmp_path / "in", f"{i}.txt", batch)
        (tmp_path / "in" / f"junk{i}.txt").write_text("no click\n" * i)
        B.blacklist_stream(
            file_lines(spark, str(tmp_path / "in")), tables, str(tmp_path / "cp"), 3, B.ALL_AVAILABLE
        ).awaitTermination()
    want = [(0, 2, 0, 0), (1, 1, 1, 0), (2, 5, 2, 0), (3, 5, 3, 1)]
    seen = tables.progress.batches
    assert pairs(seen.read(), "batch_id", "lines", "rejects", "late") == want
    # a batch that runs again, as after a failure between its clicks and its counts
    assert tables.progress.newest_before(3) == tables.progress.newest_before(4)
    assert tables.progress.newest_before(5) is not None
    assert tables.rejects.read().count() == sum(x[2] for x in want)
    assert tables.clicks.read().count() == sum(len(b) for b in batches)


def test_stream_by_the_clock(spark, tmp_path):
    """The trigger of a running job: batches start every so often until it is stopped."""
    tables = AdTables.at(spark, str(tmp_path / "tables"))
    put(tmp_path / "in", "0.txt", BATCHES[0])
    query = ad_job(file_lines(spark, str(tmp_path / "in")), tables, str(tmp_path / "cp"), 3, {"processingTime": "1 seconds"})
    try:
        for n, batch in enumerate(BATCHES[1:], 2):
            query.processAllAvailable()
            assert tables.blacklist.clicks.read().select("batch_id").distinct().count() == n - 1
            put(tmp_path / "in", f"{n}.txt", batch)
        query.processAllAvailable()
    finally:
        query.stop()
    check(tables.blacklist)
    assert B.EVERY_5_SECONDS == {"processingTime": "5 seconds"}
