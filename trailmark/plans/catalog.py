"""The registered queries: every operator over the stand-in inputs of a table folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from math import ceil
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark import schemas
from trailmark.functions import format_time, text, times
from trailmark.operators import ads, categories, filters, pages, products, sampling, sessions
from trailmark.operators.metrics import Metrics
from trailmark.params import TaskParams, load_task
from trailmark.plans import jobs
from trailmark.scratch import shared_folder, written
from trailmark.sources import standin
from trailmark.sources.tables import actions_on, file_lines, save_actions, typed_actions
from trailmark.streaming import blacklist, counts
from trailmark.streaming.tables import CountTable

# the driver tables hold at most four clicks per day, user and ad, and about 130 sessions per day
THRESHOLD = 3
SAMPLE_SIZE = 3000
JOB_SAMPLE = 1500
SEED = "trail"
FLOW = [1, 2, 3, 4, 5]
ARRIVALS = 3
FILTERS = TaskParams.parse(
    {
        "startAge": 10,
        "endAge": 50,
        "professionals": ["MACHINERY", "FURNITURE", "HOUSEHOLD"],
        "sex": ["male,female"],
        "keywords": ["kw1,kw2,kw3,kw4,kw5"],
        "categoryIds": ["1,2,3,5,8,13"],
    }
)

# a stored task, as the jobs are given it
TASK = (
    '{"startDate": ["2024-01-06"], "endDate": ["2024-01-20"], "startAge": ["10"], "endAge": ["50"],'
    ' "professionals": ["MACHINERY,FURNITURE,HOUSEHOLD"], "sex": ["male,female"],'
    ' "keywords": ["kw1,kw2,kw3,kw4,kw5"], "categoryIds": ["1,2,3,5,8,13"], "targetPageFlow": ["1,2,3,4,5"]}'
)
LEVELS = {"A level": ["ASIA", "EUROPE"], "B level": ["AMERICA"], "C level": ["AFRICA"]}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return run


def _rows(df: DataFrame, schema) -> DataFrame:
    return schemas.to_stored(df, schema).drop("task_id")


def _details(df: DataFrame) -> DataFrame:
    return _rows(df, schemas.SESSION_DETAIL)


def _session_rows(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "search_keywords": F.array_join("search_keywords", ","),
            "click_category_ids": F.array_join("click_category_ids", ","),
            "start_time": format_time(F.col("start_time")),
        }
    )


def _all_sessions(spark: SparkSession, folder: str) -> DataFrame:
    actions, users = standin.user_visit_action(spark, folder), standin.user_info(spark, folder)
    return sessions.session_aggregate(actions, users)


def _filtered(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.filter_sessions(_all_sessions(spark, folder), FILTERS)


@query
def session_aggregate(spark, folder):
    return _session_rows(_all_sessions(spark, folder))


@query
def filtered_sessions(spark, folder):
    return _session_rows(_filtered(spark, folder))


@query
def session_stats(spark, folder):
    return sessions.session_stats(_all_sessions(spark, folder))


def _summary(spark: SparkSession, folder: str, params: TaskParams | None = None) -> DataFrame:
    actions, users = standin.user_visit_action(spark, folder), standin.user_info(spark, folder)
    return sessions.session_summary(actions, users, params)


@query
def filtered_session_stats(spark, folder):
    return sessions.session_stats(_summary(spark, folder, FILTERS))


@query
def session_values(spark, folder):
    return sessions.session_values(standin.user_visit_action(spark, folder))


@query
def session_details(spark, folder):
    actions = standin.user_visit_action(spark, folder)
    kept = written(_summary(spark, folder, FILTERS).select("session_id"), shared_folder(spark), "kept")
    return _details(sessions.session_details(actions, kept))


@query
def session_stats_of_saved_log(spark, folder):
    """From a log saved in the catalogue by date, of the Mondays in a table of dates."""
    log = f"trailmark_log_{uuid4().hex}"
    save_actions(standin.user_visit_action(spark, folder), log, f"{shared_folder(spark)}/log")
    days = spark.table(log).select("session_date").distinct()
    mondays = written(days.where(F.weekday(F.to_date("session_date")) == 0), shared_folder(spark), "dates")
    users = standin.user_info(spark, folder)
    return sessions.session_stats(sessions.session_summary(actions_on(spark.table(log), mondays), users))


def _counted(spark: SparkSession, result: DataFrame, metrics: Metrics) -> DataFrame:
    """Runs a result and returns the counts beside it, one row per name."""
    result.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(metrics.values().items()), "name string, rows long")


@query
def unmatched_counts(spark, folder):
    """Sessions, clicks and products that the joins drop, of users, cities and products without every third one."""
    metrics, by_product = Metrics(), Metrics()
    log = standin.user_visit_action(spark, folder)

    def part(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col(key) % 3 != 0)

    cities = part(standin.city_info(spark, folder), "city_id")
    users, items = part(standin.user_info(spark, folder), "user_id"), part(standin.product_info(spark, folder), "product_id")
    per_session = sessions.session_summary(log, users, FILTERS, metrics)
    per_area = products.area_product_clicks(products.product_clicks(log), cities, by_product)
    top = Metrics()
    best = products.area_top_products(log, cities, items, metrics=top)
    counted = _counted(spark, per_session, metrics).unionByName(_counted(spark, per_area, by_product))
    return counted.unionByName(_counted(spark, best, top).where("name = 'clicks_of_unknown_products'"))


@query
def session_first_days(spark, folder):
    """Whether a session started today, yesterday or before, by the clock; the clock moves, the rows do not."""
    days = _summary(spark, folder).groupBy(F.to_date("start_time").alias("day")).agg(F.count(F.lit(1)).alias("sessions"))
    is_recent = F.col("day") >= times.yesterday()
    return days.select(
        times.format_date(F.col("day")).alias("date"),
        "sessions",
        is_recent.alias("recent"),
        F.date_diff(times.today(), times.yesterday()).alias("step"),
    )


@query
def sessions_per_hour(spark, folder):
    return sessions.sessions_per_hour(_summary(spark, folder))


@query
def session_hour_share(spark, folder):
    return sessions.session_hour_share(_all_sessions(spark, folder))


def _sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample_sessions(_all_sessions(spark, folder), SAMPLE_SIZE, SEED)


@query
def session_sample(spark, folder):
    return _rows(_sample(spark, folder), schemas.SESSION_RANDOM_EXTRACT)


@query
def session_sample_details(spark, folder):
    actions = standin.user_visit_action(spark, folder)
    sample = written(_sample(spark, folder).select("session_id"), shared_folder(spark), "sample")
    return _details(sampling.sample_details(sample, actions))


@query
def category_counts(spark, folder):
    return categories.category_counts(standin.user_visit_action(spark, folder))


@query
def top10_categories(spark, folder):
    return categories.top_categories(categories.category_counts(standin.user_visit_action(spark, folder)))


@query
def session_category_clicks(spark, folder):
    return categories.session_category_clicks(standin.user_visit_action(spark, folder))


def _top_sessions(actions: DataFrame) -> DataFrame:
    top = categories.top_categories(categories.category_counts(actions))
    return categories.top_sessions_per_category(actions, top)


@query
def top10_sessions_per_category(spark, folder):
    return _top_sessions(standin.user_visit_action(spark, folder))


@query
def top_session_details(spark, folder):
    actions = standin.user_visit_action(spark, folder)
    top = written(_top_sessions(actions), shared_folder(spark), "top_sessions")
    return _details(categories.top_session_details(actions, top))


@query
def top_session_details_per_category(spark, folder):
    actions = standin.user_visit_action(spark, folder)
    top = written(_top_sessions(actions), shared_folder(spark), "top_sessions")
    details = categories.top_session_details(actions, top, per_category=True)
    stored = schemas.SESSION_DETAIL.names[1:]
    return details.select("category_id", *stored).withColumn("action_time", format_time(F.col("action_time")))


@query
def page_pair_counts(spark, folder):
    return pages.page_pair_counts(standin.user_visit_action(spark, folder), FLOW, ["event_id"])


@query
def page_conversion(spark, folder):
    return pages.page_conversion(standin.user_visit_action(spark, folder), FLOW, ["event_id"])


@query
def page_split_convert_rate(spark, folder):
    actions = standin.user_visit_action(spark, folder)
    return pages.conversion_text(pages.page_conversion(actions, FLOW, ["event_id"]))


@query
def area_product_clicks(spark, folder):
    clicks = products.product_clicks(standin.user_visit_action(spark, folder))
    return products.area_product_clicks(clicks, standin.city_info(spark, folder))


@query
def area_top3_products(spark, folder):
    return products.area_top_products(
        standin.user_visit_action(spark, folder),
        standin.city_info(spark, folder),
        standin.product_info(spark, folder),
    )


def _clicks(spark: SparkSession, folder: str) -> DataFrame:
    return ads.parse_ad_log(standin.ad_log_lines(standin.events(spark, folder), spark, folder))


def _click_rows(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))


@query
def ad_log_parsed(spark, folder):
    return _click_rows(_clicks(spark, folder))


@query
def ad_user_daily_clicks(spark, folder):
    return ads.user_daily_clicks(_clicks(spark, folder))


@query
def ad_blacklist(spark, folder):
    return ads.daily_blacklist(_clicks(spark, folder), THRESHOLD)


@query
def ad_clicks_after_blacklist(spark, folder):
    clicks = _clicks(spark, folder)
    listed = written(ads.daily_blacklist(clicks, THRESHOLD), shared_folder(spark), "blacklist")
    return _click_rows(ads.clicks_until_flagged(clicks, listed))


@query
def ad_stat(spark, folder):
    return ads.ad_stat(_clicks(spark, folder))


@query
def ad_province_top3(spark, folder):
    return ads.province_top_ads(ads.ad_stat(_clicks(spark, folder)))


@query
def ad_click_trend(spark, folder):
    return ads.click_trend(ads.minute_clicks(ads.last_minutes(_clicks(spark, folder))))


def _arrivals(spark: SparkSession, folder: str, work: str, backwards: bool = False, broken: bool = False):
    """Writes the events' lines in parts of equal numbers of days, and yields after each."""
    day = F.to_date("ts")
    events = standin.events(spark, folder)
    first, last = events.agg(F.min(day), F.max(day)).first()
    days = (last - first).days + 1
    starts = [first + timedelta(days=ceil(i * days / ARRIVALS)) for i in range(ARRIVALS + 1)]
    parts = list(zip(starts, starts[1:]))
    for start, stop in reversed(parts) if backwards else parts:
        part = events.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(stop)))
        lines = standin.ad_log_lines(part, spark, folder)
        if broken:
            errors = part.where("event_type = 'error'")
            lines = lines.unionByName(errors.select(F.concat(F.lit("broken "), "event_id").alias("value")))
        lines.write.mode("append").text(f"{work}/lines")
        yield


def _run_blacklist(spark: SparkSession, folder: str, then=None) -> blacklist.BlacklistTables:
    """The days of the events arrive in three parts of equal length, each the stream's next micro-batch."""
    work = shared_folder(spark)
    tables = blacklist.BlacklistTables.at(spark, f"{work}/tables")
    for _ in _arrivals(spark, folder, work):
        blacklist.blacklist_stream(
            file_lines(spark, f"{work}/lines"),
            tables,
            f"{work}/checkpoint",
            THRESHOLD,
            blacklist.ALL_AVAILABLE,
            then,
        ).awaitTermination()
    return tables


@query
def ad_blacklist_stream(spark, folder):
    return _run_blacklist(spark, folder).blacklist.read().select("user_id")


@query
def ad_user_clicks_stream(spark, folder):
    return _run_blacklist(spark, folder).user_clicks.current()


@query
def ad_filtered_stat_stream(spark, folder):
    stat = CountTable(spark, f"{shared_folder(spark)}/stat", schemas.AD_STAT)
    _run_blacklist(spark, folder, lambda clicks, batch: counts.add_stat(clicks, batch, stat))
    return stat.current()


@query
def ad_stream_metrics(spark, folder):
    """Lines, rejects and late clicks of each batch. The latest days arrive first; `error` events leave broken lines."""
    work = shared_folder(spark)
    tables = blacklist.BlacklistTables.at(spark, f"{work}/tables")
    for _ in _arrivals(spark, folder, work, backwards=True, broken=True):
        blacklist.blacklist_stream(
            file_lines(spark, f"{work}/lines"), tables, f"{work}/checkpoint", THRESHOLD, blacklist.ALL_AVAILABLE
        ).awaitTermination()
    return tables.progress.batches.read()


def _click_stream(spark: SparkSession, folder: str) -> DataFrame:
    return ads.parse_ad_log(standin.ad_log_lines(standin.events_stream(spark, folder), spark, folder))


def _run_stat(spark: SparkSession, folder: str, top: counts.ProvinceTop | None = None) -> CountTable:
    work = shared_folder(spark)
    stat = CountTable(spark, f"{work}/stat", schemas.AD_STAT)
    counts.ad_stat_stream(
        _click_stream(spark, folder),
        stat,
        f"{work}/checkpoint",
        top,
        trigger=blacklist.ALL_AVAILABLE,
    ).awaitTermination()
    return stat


@query
def ad_stat_stream(spark, folder):
    return _run_stat(spark, folder).current()


@query
def ad_province_top3_stream(spark, folder):
    top = counts.ProvinceTop.at(spark, shared_folder(spark))
    _run_stat(spark, folder, top)
    return top.read()


def _newest(spark: SparkSession, folder: str) -> datetime:
    """The clock of a stream over stored events: the time of the last one."""
    last = standin.events(spark, folder).agg(F.max("ts")).first()[0]
    return last.replace(tzinfo=timezone.utc)


@query
def ad_click_trend_stream(spark, folder):
    work = shared_folder(spark)
    trend = counts.trend_table(spark, f"{work}/trend")
    counts.click_trend_stream(
        _click_stream(spark, folder), trend, f"{work}/checkpoint", trigger=blacklist.ALL_AVAILABLE
    ).awaitTermination()
    return counts.last_hour(trend, until=_newest(spark, folder))


def _run_late(spark: SparkSession, folder: str, table: CountTable, add, work: str) -> CountTable:
    """The latest days arrive first. Every batch runs twice, as after a failure, and counts are folded."""
    for i, _ in enumerate(_arrivals(spark, folder, work, backwards=True)):
        lines = file_lines(spark, f"{work}/lines")

        def run(batch: DataFrame, batch_id: int) -> None:
            add(ads.parse_ad_log(batch), batch_id, table)
            add(ads.parse_ad_log(batch), batch_id, table)

        blacklist.start(
            lines.writeStream.foreachBatch(run), f"{work}/checkpoint", blacklist.ALL_AVAILABLE
        ).awaitTermination()
    return table


@query
def ad_stat_late_stream(spark, folder):
    work = shared_folder(spark)
    stat = CountTable(spark, f"{work}/stat", schemas.AD_STAT, fold_every=2)
    return _run_late(spark, folder, stat, counts.add_stat, work).current()


@query
def ad_click_trend_late_stream(spark, folder):
    work = shared_folder(spark)
    trend = CountTable(spark, f"{work}/trend", schemas.AD_CLICK_TREND, fold_every=2)
    return _run_late(spark, folder, trend, counts.add_trend, work).current()


@query
def page_pair_counts_of_hot_sessions(spark, folder):
    """As `page_pair_counts`, with sessions of a few rows taken as hot already."""
    actions = standin.user_visit_action(spark, folder)
    return pages.page_pair_counts(actions, FLOW, ["event_id"], hot_rows=3)


def _task(spark: SparkSession) -> TaskParams:
    return load_task(spark.createDataFrame([(7, TASK)], "task_id long, task_param string"), 7)


def _text_log(spark: SparkSession, folder: str) -> DataFrame:
    """The action log with times as text, hours without leading zero."""
    log = standin.user_visit_action(spark, folder)
    return log.withColumn("action_time", F.date_format("action_time", "yyyy-MM-dd H:mm:ss"))


@query
def action_text_keys(spark, folder):
    """Times as the text keys of the stored tables and back, and lists of ids in text."""
    log = typed_actions(_text_log(spark, folder))
    time, ids = F.col("action_time"), F.col("order_category_ids")
    return log.select(
        "event_id",
        times.date_key(time).alias("date_key"),
        times.hour_key(time).alias("hour_key"),
        times.minute_key(time).alias("minute_key"),
        times.format_date(times.parse_date_key(times.date_key(time))).alias("date"),
        text.join_csv(text.csv_longs(ids).cast("array<string>")).alias("order_categories"),
        text.trim_comma(F.concat(F.lit(","), ids, F.lit(","))).alias("trimmed"),
    )


def _session_job(spark: SparkSession, folder: str) -> str:
    """The job from task JSON, with a date range and times as text; its tables are read back."""
    out = shared_folder(spark)
    users = standin.user_info(spark, folder)
    jobs.session_job(_text_log(spark, folder), users, _task(spark), 7, out, JOB_SAMPLE, SEED)
    return out


@query
def session_job_stats(spark, folder):
    return spark.read.parquet(f"{_session_job(spark, folder)}/session_aggr_stat")


@query
def session_job_sample(spark, folder):
    return spark.read.parquet(f"{_session_job(spark, folder)}/session_random_extract")


@query
def session_job_details(spark, folder):
    """Those of the sampled sessions and of the most active ones, each session once for each of the two."""
    return spark.read.parquet(f"{_session_job(spark, folder)}/session_detail")


@query
def session_job_categories(spark, folder):
    return spark.read.parquet(f"{_session_job(spark, folder)}/top10_category")


@query
def session_job_top_sessions(spark, folder):
    return spark.read.parquet(f"{_session_job(spark, folder)}/top10_category_session")


@query
def page_job_rates(spark, folder):
    out = shared_folder(spark)
    jobs.page_job(_text_log(spark, folder), _task(spark), 7, out, ["event_id"])
    return spark.read.parquet(f"{out}/page_split_convert_rate")


@query
def area_job_top3(spark, folder):
    out = shared_folder(spark)
    jobs.area_job(
        _text_log(spark, folder),
        standin.city_info(spark, folder),
        standin.product_info(spark, folder),
        _task(spark),
        7,
        out,
        levels=LEVELS,
    )
    return spark.read.parquet(f"{out}/area_top3_product")
