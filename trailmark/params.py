"""Task parameters: the filters and ranges a job is started with.

In a stored task (JSON text) a value is a list of which the first element counts, a comma-separated text, e.g.
{"keywords": ["kw1,kw2"]}. A mapping built in Python may also hold plain texts, numbers and lists of values.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def values(params: Mapping[str, Any], name: str) -> list[str] | None:
    """All values of a parameter, or None when it is absent or blank."""
    raw = params.get(name)
    if raw is None:
        return None
    items = raw if isinstance(raw, (list, tuple)) else [raw]
    parts = [p.strip() for item in items if item is not None for p in str(item).split(",")]
    return [p for p in parts if p] or None


def single(params: Mapping[str, Any], name: str) -> str | None:
    found = values(params, name)
    return found[0] if found else None


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


@dataclass(frozen=True)
class TaskParams:
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: list[str] | None = None
    cities: list[str] | None = None
    sex: list[str] | None = None
    keywords: list[str] | None = None
    category_ids: list[int] | None = None
    page_flow: list[int] | None = None

    @classmethod
    def parse(cls, source: str | Mapping[str, Any]) -> "TaskParams":
        if isinstance(source, str):
            stored = json.loads(source)
            params = {name: v[:1] if isinstance(v, list) else v for name, v in stored.items()}
        else:
            params = source
        categories = values(params, "categoryIds")
        flow = values(params, "targetPageFlow")
        return cls(
            start_date=single(params, "startDate"),
            end_date=single(params, "endDate"),
            start_age=_number(single(params, "startAge")),
            end_age=_number(single(params, "endAge")),
            professionals=values(params, "professionals"),
            cities=values(params, "cities"),
            sex=values(params, "sex"),
            keywords=values(params, "keywords"),
            category_ids=None if categories is None else [int(c) for c in categories],
            page_flow=None if flow is None else [int(p) for p in flow],
        )

    def need(self, *names: str) -> "TaskParams":
        for name in names:
            if getattr(self, name) is None:
                raise ValueError(f"task parameter {name!r} is missing")
        return self


def load_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """The parameters of one task, read from a table with columns task_id and task_param."""
    rows = tasks.where(F.col("task_id") == task_id).select("task_param").take(1)
    if not rows or not rows[0].task_param:
        raise ValueError(f"there is no task {task_id} with parameters")
    return TaskParams.parse(rows[0].task_param)
