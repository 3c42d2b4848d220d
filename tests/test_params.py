from __future__ import annotations

import json

import pytest

from trailmark.params import TaskParams, load_task

STORED = {
    "startDate": ["2024-01-01"],
    "endDate": ["2024-01-30"],
    "startAge": ["20"],
    "endAge": ["50"],
    "professionals": ["a, b"],
    "sex": [],
    "keywords": [""],
    "categoryIds": ["1,2", "3"],
    "targetPageFlow": ["1,2,3"],
}


def test_stored_task_takes_the_first_element():
    p = TaskParams.parse(json.dumps(STORED))
    assert (p.start_date, p.end_date, p.start_age, p.end_age) == ("2024-01-01", "2024-01-30", 20, 50)
    assert p.professionals == ["a", "b"]
    assert p.sex is None and p.keywords is None and p.cities is None
    assert p.category_ids == [1, 2]
    assert p.page_flow == [1, 2, 3]


def test_mapping_takes_plain_values_and_lists():
    p = TaskParams.parse({"startAge": 20, "keywords": ["a", "b,c"], "categoryIds": [1, 2]})
    assert p.start_age == 20 and p.end_age is None
    assert p.keywords == ["a", "b", "c"] and p.category_ids == [1, 2]


def test_missing_parameter_is_named():
    with pytest.raises(ValueError, match="end_date"):
        TaskParams.parse({"startDate": "2024-01-01"}).need("start_date", "end_date")


def test_load_task(spark):
    tasks = spark.createDataFrame([(1, json.dumps(STORED)), (2, None)], "task_id long, task_param string")
    assert load_task(tasks, 1).start_age == 20
    for missing in (2, 3):
        with pytest.raises(ValueError):
            load_task(tasks, missing)
