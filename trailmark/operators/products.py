"""Most clicked products of each area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions import area_level, concat_long_string, group_concat_distinct, product_status
from trailmark.operators.metrics import Metrics, inner_join
from trailmark.operators.topn import top_n_per_group


def product_clicks(actions: DataFrame) -> DataFrame:
    """city_id and product_id of the actions that click a product."""
    clicks = actions.where(F.col("click_product_id").isNotNull())
    return clicks.select("city_id", F.col("click_product_id").alias("product_id"))


def _city_clicks(
    clicks: DataFrame, cities: DataFrame, known: DataFrame | None = None, metrics: Metrics | None = None
) -> DataFrame:
    """Clicks per (area, city, product), of `known` products if given. Counted per city and product first, so
    that a hot product or city is combined before it meets the other tables."""
    counts = clicks.groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("click_count"))
    if known is not None and metrics is None:
        counts = counts.join(known.select("product_id"), "product_id", "left_semi")
    elif known is not None:
        products = known.select("product_id")
        counts = inner_join(counts, products, "product_id", metrics, "clicks_of_unknown_products", F.col("click_count"))
    places = cities.select(F.col("city_id").cast("long").alias("city_id"), "city_name", "area")
    return inner_join(counts, places, "city_id", metrics, "clicks_in_unknown_cities", F.col("click_count"))


def _with_city_infos(city_clicks: DataFrame) -> DataFrame:
    info = group_concat_distinct(concat_long_string(F.col("city_id"), F.col("city_name")))
    return city_clicks.groupBy("area", "product_id").agg(
        F.sum("click_count").alias("click_count"), info.alias("city_infos")
    )


def area_product_clicks(clicks: DataFrame, cities: DataFrame, metrics: Metrics | None = None) -> DataFrame:
    """Clicks per area and product, with the list of cities they come from (`id:name`, ascending).

    Clicks in unknown cities are left out, and counted as `clicks_in_unknown_cities` if `metrics` is given.
    """
    return _with_city_infos(_city_clicks(clicks, cities, metrics=metrics))


def area_top_products(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    n: int = 3,
    levels: Mapping[str, Sequence[str]] | None = None,
    metrics: Metrics | None = None,
) -> DataFrame:
    """The n most clicked known products of each area (ties by product id; product ids are unique).

    With `metrics`, `clicks_of_unknown_products` are counted, and of the other clicks `clicks_in_unknown_cities`.

    Ranking needs counts only. City lists, names and status are put together afterwards, for the winners.
    """
    city_clicks = _city_clicks(product_clicks(actions), cities, products, metrics)
    counts = city_clicks.groupBy("area", "product_id").agg(F.sum("click_count").alias("click_count"))
    top = top_n_per_group(counts, ["area"], [F.col("click_count").desc(), F.col("product_id")], n)
    winners = top.select("area", "product_id")
    # the same counts per city are read again: one shuffle serves both
    placed = _with_city_infos(city_clicks.join(winners, ["area", "product_id"], "left_semi"))
    described = products.select(
        "product_id", "product_name", product_status(F.col("extend_info")).alias("product_status")
    )
    return described.join(placed, "product_id").select(
        "area",
        area_level(F.col("area"), levels).alias("area_level"),
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        "product_status",
    )
