"""Small hand-made frames."""

from __future__ import annotations

import datetime as dt

OBSERVATIONS = (
    "entity string, category string, item string, price double, observed_at timestamp_ntz,"
    " session_id string, ordinal long"
)
CONDITIONS = (
    "session_id string, is_rainy boolean, temperature double, recorded_at timestamp_ntz"
)
CHANGES = (
    "entity string, category string, item string, dish_type string, hour_of_day int,"
    " is_weekend boolean, is_rainy boolean, temperature_band string, new_price double,"
    " pct_change double"
)
BASE = "entity string, category string, dish_type string, hour_of_day int"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def observations(spark, rows):
    """Rows of (entity, category, item, price, time text, session)."""
    return spark.createDataFrame(
        [
            (e, c, i, None if p is None else float(p), at(t), s, n)
            for n, (e, c, i, p, t, s) in enumerate(rows)
        ],
        OBSERVATIONS,
    )


def conditions(spark, rows):
    """Rows of (session, rainy, temperature, time text)."""
    return spark.createDataFrame([(s, r, t, at(w)) for s, r, t, w in rows], CONDITIONS)


def changes(spark, rows):
    """Rows of dicts; what is left out is NULL or a default."""
    defaults = {
        "entity": "a", "category": "c", "item": "i", "dish_type": "Momo", "hour_of_day": 12,
        "is_weekend": False, "is_rainy": None, "temperature_band": None, "new_price": 100.0,
        "pct_change": 1.0,
    }
    return spark.createDataFrame([tuple({**defaults, **r}.values()) for r in rows], CHANGES)


def base(spark, rows):
    """Rows of (entity, category, dish type, hour)."""
    return spark.createDataFrame(rows, BASE)


def rows(frame, *columns):
    columns = columns or tuple(frame.columns)
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
