"""Top categories by clicks, orders and payments, and the most active sessions in each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.operators.sessions import session_details
from trailmark.operators.topn import top_n_per_group

KINDS = ("click", "order", "pay")


def category_counts(details: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category in one aggregation; a list naming a category twice counts it
    twice. Each row is opened into (kind, category) and combined before the only shuffle."""
    lists = F.array(F.col("click_category_id").cast("string"), "order_category_ids", "pay_category_ids")
    opened = (
        details.select(F.posexplode(lists).alias("kind", "ids"))
        .where(F.col("ids").isNotNull())
        .select("kind", F.explode(F.split("ids", ",")).alias("id"))
        .select("kind", F.trim("id").try_cast("bigint").alias("category_id"))
        .where(F.col("category_id").isNotNull())
    )
    return opened.groupBy("category_id").agg(
        *[F.count_if(F.col("kind") == i).alias(f"{kind}_count") for i, kind in enumerate(KINDS)]
    )


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The first n by clicks, then orders, then payments, all descending; ties by category id."""
    descending = [F.col(c).desc() for c in ("click_count", "order_count", "pay_count")]
    return counts.orderBy(*descending, "category_id").limit(n)


def session_category_clicks(details: DataFrame) -> DataFrame:
    clicks = details.where(F.col("click_category_id").isNotNull())
    return clicks.groupBy(F.col("click_category_id").alias("category_id"), "session_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def top_sessions_per_category(details: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """The n sessions with most clicks in each category of `top`; ties by id.

    Clicks of other categories are dropped before the count. The limit in `top` tells the planner its size.
    """
    wanted = top.select(F.col("category_id").alias("click_category_id"))
    clicks = details.select("session_id", "click_category_id").join(wanted, "click_category_id")
    return top_n_per_group(
        session_category_clicks(clicks), ["category_id"], [F.col("click_count").desc(), F.col("session_id")], n
    )


def top_session_details(
    details: DataFrame, top_sessions: DataFrame, per_category: bool = False
) -> DataFrame:
    """The actions of the top sessions, each once; with `per_category` once for every category the session is
    top in, with that `category_id`. `top_sessions` should be a stored table."""
    if per_category:
        return details.join(top_sessions.select("session_id", "category_id"), "session_id")
    return session_details(details, top_sessions)
