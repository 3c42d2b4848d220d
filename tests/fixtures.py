"""Hand-made rows in the shapes of trailmark.schemas."""

from __future__ import annotations

from datetime import datetime, timedelta

from trailmark import schemas

START = datetime(2024, 1, 1, 8, 0, 0)
ACTION_COLUMNS = [f.name for f in schemas.ACTIONS.fields] + ["event_id"]


def actions(spark, *rows):
    """Rows as dicts; what is not given is NULL. `at` is seconds after START."""
    schema = schemas.columns(
        ", ".join(f"{f.name} {f.dataType.typeName()}" for f in schemas.ACTIONS.fields) + ", event_id long"
    )
    data = []
    for i, row in enumerate(rows):
        row = dict(row)
        time = row.pop("time", None) or START + timedelta(seconds=row.pop("at", 0))
        full = {
            "session_id": "s",
            "user_id": 1,
            "page_id": 1,
            "city_id": 1,
            "session_date": time.strftime("%Y-%m-%d"),
            "action_time": time,
            "event_id": i,
            **row,
        }
        data.append(tuple(full.get(c) for c in ACTION_COLUMNS))
    return spark.createDataFrame(data, schema)


def users(spark, *rows):
    rows = rows or ((1, "u", "n", 30, "p1", "c1", "male"),)
    return spark.createDataFrame(list(rows), schemas.USERS)


def clicks(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.CLICKS)


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
