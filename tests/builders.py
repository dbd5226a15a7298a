"""Small hand-made inputs."""

from __future__ import annotations

import datetime as dt

from ebbtide.schemas import ACTIVITY_SCHEMA, ATTRIBUTES_SCHEMA, HOLIDAY_SCHEMA


def day(text: str | dt.date | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if isinstance(text, str) else text


def activity(spark, rows):
    """Rows of ``(ID, start, value)``; the value fills all measures, ``None`` stays null."""
    made = []
    for user, start, value in rows:
        whole = None if value is None else int(value)
        real = None if value is None else float(value)
        made.append((user, None, None, day(start), whole, whole, whole, whole, real, real, real, "web"))
    return spark.createDataFrame(made, ACTIVITY_SCHEMA)


def attributes(spark, countries: dict):
    made = [(u, None if u % 2 else "Phone", c, "NL", "F", bool(u % 2)) for u, c in countries.items()]
    return spark.createDataFrame(made, ATTRIBUTES_SCHEMA)


def holidays(spark, rows):
    return spark.createDataFrame([(c, day(h)) for c, h in rows], HOLIDAY_SCHEMA)
