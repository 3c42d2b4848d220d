from __future__ import annotations

from fixtures import actions, pairs
from trailmark import schemas
from trailmark.operators import products as P

CITIES = [(1, "a", "华北"), (11, "a", "华北"), (2, "b", "东北")]


def setup(spark):
    rows = []
    clicks = ((1, 7, 2), (11, 7, 1), (1, 8, 3), (1, 9, 4), (1, 10, 1), (2, 7, 1), (5, 7, 9), (1, 99, 50))
    for city, product, n in clicks:
        rows += [{"city_id": city, "click_product_id": product}] * n
    log = actions(spark, *rows, {"city_id": 1})
    cities = spark.createDataFrame(CITIES, schemas.CITIES)
    info = [
        (7, "seven", '{"product_status": 0}'),
        (8, "eight", '{"product_status": 1}'),
        (9, "nine", "{}"),
        (10, "ten", "{broken"),
    ]
    return log, cities, spark.createDataFrame(info, schemas.PRODUCTS)


def test_counts_with_city_lists(spark):
    log, cities, _ = setup(spark)
    counts = P.area_product_clicks(P.product_clicks(log), cities)
    got = pairs(counts, "area", "product_id", "click_count", "city_infos")
    assert ("华北", 7, 3, "11:a,1:a") in got and ("东北", 7, 1, "2:b") in got
    assert ("华北", 99, 50, "1:a") in got and len(got) == 6


def test_top_products_of_known_products(spark):
    log, cities, info = setup(spark)
    top = P.area_top_products(log, cities, info, n=3)
    columns = [f.name for f in schemas.AREA_TOP3_PRODUCT.fields if f.name != "task_id"]
    assert pairs(top, *columns) == [
        ("东北", "D level", 7, "2:b", 1, "seven", "self"),
        ("华北", "A level", 7, "11:a,1:a", 3, "seven", "self"),
        ("华北", "A level", 8, "1:a", 3, "eight", "third party"),
        ("华北", "A level", 9, "1:a", 4, "nine", "third party"),
    ]
    two = P.area_top_products(log, cities, info, n=2, levels={"north": ["华北", "东北"]})
    assert pairs(two, "area_level", "product_id") == [("north", 7), ("north", 7), ("north", 9)]
