"""The batch jobs from task parameters to stored result tables, and the ad job from a stream of lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trailmark import schemas, sinks
from trailmark.operators import categories, pages, products, sampling, sessions
from trailmark.operators.ads import BLACKLIST_THRESHOLD
from trailmark.params import TaskParams
from trailmark.scratch import shared_folder, written
from trailmark.sources.tables import task_actions
from trailmark.streaming.blacklist import EVERY_5_SECONDS, BlacklistTables, blacklist_stream
from trailmark.streaming.counts import ProvinceTop, add_stat, add_trend, trend_table
from trailmark.streaming.tables import CountTable

CATEGORY_COLUMNS = ("click_category_id", "order_category_ids", "pay_category_ids")


def session_job(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    task_id: int,
    out: str,
    sample_size: int = 100,
    seed: str = "",
    top: int = 10,
) -> None:
    """Writes session_aggr_stat, session_random_extract, session_detail, top10_category and
    top10_category_session below `out`.

    The filtered sessions, and of their actions the columns that name categories, are written to the shared
    folder once. The details stored in the end belong to a bounded number of sessions and come from the log.
    """
    folder = shared_folder(actions.sparkSession)
    log = task_actions(actions, params)
    kept = written(sessions.session_summary(log, users, params), folder, "sessions")
    mentions = log.select("session_id", *CATEGORY_COLUMNS).where(
        " or ".join(f"{c} is not null" for c in CATEGORY_COLUMNS)
    )
    mentions = written(sessions.session_details(mentions, kept), folder, "mentions")

    def store(df: DataFrame, table: str, schema, write) -> None:
        write(schemas.to_stored(df, schema, task_id), f"{out}/{table}")

    store(sessions.session_stats(kept), "session_aggr_stat", schemas.SESSION_AGGR_STAT, sinks.append)

    sample = written(sampling.sample_sessions(kept, sample_size, seed), folder, "sample")
    store(sessions.with_lists(sample, log), "session_random_extract", schemas.SESSION_RANDOM_EXTRACT, sinks.append)
    drawn = sampling.sample_details(sample, log)
    store(drawn, "session_detail", schemas.SESSION_DETAIL, sinks.append)

    best = written(
        categories.top_categories(categories.category_counts(mentions), top), folder, "top_categories"
    )
    store(best, "top10_category", schemas.TOP10_CATEGORY, sinks.overwrite)
    active = written(
        categories.top_sessions_per_category(mentions, best, top), folder, "top_sessions"
    )
    store(active, "top10_category_session", schemas.TOP10_CATEGORY_SESSION, sinks.overwrite)
    clicked = categories.top_session_details(log, active)
    store(clicked, "session_detail", schemas.SESSION_DETAIL, sinks.append)


def page_job(
    actions: DataFrame, params: TaskParams, task_id: int, out: str, tie_breakers: Sequence[str] = ()
) -> None:
    """Writes page_split_convert_rate below `out`."""
    flow = params.need("page_flow").page_flow
    conversion = pages.page_conversion(task_actions(actions, params), flow, tie_breakers)
    text = schemas.to_stored(pages.conversion_text(conversion), schemas.PAGE_SPLIT_CONVERT_RATE, task_id)
    sinks.append(text, f"{out}/page_split_convert_rate")


def area_job(
    actions: DataFrame,
    cities: DataFrame,
    product_table: DataFrame,
    params: TaskParams,
    task_id: int,
    out: str,
    n: int = 3,
    levels: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Writes area_top3_product below `out`."""
    top = products.area_top_products(task_actions(actions, params), cities, product_table, n, levels)
    sinks.overwrite(
        schemas.to_stored(top, schemas.AREA_TOP3_PRODUCT, task_id), f"{out}/area_top3_product"
    )


@dataclass(frozen=True)
class AdTables:
    blacklist: BlacklistTables
    stat: CountTable
    trend: CountTable
    top: ProvinceTop

    @classmethod
    def at(cls, spark, folder: str) -> "AdTables":
        return cls(
            BlacklistTables.at(spark, folder),
            CountTable(spark, f"{folder}/ad_stat", schemas.AD_STAT),
            trend_table(spark, f"{folder}/ad_click_trend"),
            ProvinceTop.at(spark, folder),
        )


def ad_job(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    threshold: int = BLACKLIST_THRESHOLD,
    trigger: dict = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Starts one stream that runs the blacklist on the lines and adds the clicks it lets through to all counts."""

    def count(clicks: DataFrame, batch_id: int) -> None:
        add_stat(clicks, batch_id, tables.stat, tables.top)
        add_trend(clicks, batch_id, tables.trend)

    return blacklist_stream(lines, tables.blacklist, checkpoint, threshold, trigger, count)
