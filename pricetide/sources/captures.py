"""Prices from captured pages and conditions from weather payloads."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.functions import scalars as S

# The page state's assignment and the keys of names and prices.
STATE_PATTERN = r'(?s)window\.__PRELOADED_STATE__\s*=\s*JSON\.parse\("(.+?)"\);'
NAME_KEYS = frozenset({"name", "item_name", "dish_name", "title"})
PRICE_KEYS = frozenset({"price", "cost", "item_price", "display_price"})
MAX_DEPTH = 15

WEATHER_PAYLOAD = (
    "struct<main:struct<temp:double,humidity:int>,"
    "weather:array<struct<main:string,description:string>>,"
    "wind:struct<speed:double>,name:string>"
)


#: A price from here on has no place in a long.
PRICE_END = 2**63


def _number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool) and value > 0


def priced_objects(state, max_depth: int = MAX_DEPTH, faults: set | None = None) -> Iterator[tuple[str, int]]:
    """(name, price) of every object holding both, parents before children.

    Of several matching keys in one object the last in the document counts.  What is left
    out is noted in ``faults``: ``depth`` for lists and objects below ``max_depth``, ``price`` for
    prices beyond a long.
    """
    faults = set() if faults is None else faults
    pending = [(state, 0)]
    while pending:
        node, depth = pending.pop()
        if not isinstance(node, (dict, list)):
            continue
        if depth > max_depth:
            faults.add("depth")
            continue
        children = node
        if isinstance(node, dict):
            name = price = None
            for key, value in node.items():
                key = key.lower()
                if key in NAME_KEYS and isinstance(value, str) and value:
                    name = value
                elif key in PRICE_KEYS and _number(value):
                    if value < PRICE_END:
                        price = int(value)
                    else:
                        faults.add("price")
            if name is not None and price is not None:
                yield name, price
            children = list(node.values())
        pending.extend((child, depth + 1) for child in reversed(children))


def _decode(escaped: str):
    """The page state behind a JSON string literal; an error where it is not one."""
    return json.loads(json.loads(f'"{escaped}"', strict=False), strict=False)


def walk_pages(
    pages: DataFrame, key: str = "page_id", html: str = "html", max_depth: int = MAX_DEPTH
) -> DataFrame:
    """What each page with a state holds: ``ordinal, item, price`` per priced object, and its faults.

    A fault is a row of its own with a ``reason``: ``state`` for one that cannot be read, ``depth`` and
    ``price`` as in :func:`priced_objects`.  The state is cut out by Spark, so Python sees only
    pages that have one and of those only the state.
    """
    states = pages.select(
        F.col(key), F.regexp_extract(html, STATE_PATTERN, 1).alias("state")
    ).where(F.col("state") != "")
    kind = pages.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, ordinal int, item string, price long, reason string"

    def found(page, state) -> Iterator[tuple]:
        faults: set[str] = set()
        try:
            decoded = _decode(state)
        except (ValueError, RecursionError):
            faults.add("state")
        else:
            for number, (name, price) in enumerate(priced_objects(decoded, max_depth, faults)):
                yield page, number, name, price, None
        for fault in sorted(faults):
            yield page, None, None, None, fault

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [row for page, state in zip(batch[key], batch["state"]) for row in found(page, state)]
            frame = pd.DataFrame(rows, columns=[key, "ordinal", "item", "price", "reason"])
            yield frame.astype({"ordinal": "Int32", "price": "Int64"})

    return states.mapInPandas(walk, schema)


def extract_prices(
    pages: DataFrame, key: str = "page_id", html: str = "html", max_depth: int = MAX_DEPTH
) -> DataFrame:
    """Name and price pairs of each page, numbered in document order."""
    return walk_pages(pages, key, html, max_depth).where("reason is null").drop("reason")


def embed_state(html, state_json):
    """Column expression: a page with ``state_json`` embedded as page state."""
    escaped = F.replace(
        F.replace(state_json, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')
    )
    return F.concat(
        html,
        F.lit('<script>window.__PRELOADED_STATE__ = JSON.parse("'),
        escaped,
        F.lit('");</script>'),
    )


def flatten_weather(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Condition rows from raw weather payloads; other columns are kept."""
    rest = [c for c in payloads.columns if c != body]
    weather = F.try_element_at("payload.weather", F.lit(1))
    return payloads.select(*rest, F.from_json(body, WEATHER_PAYLOAD).alias("payload")).select(
        *rest,
        F.col("payload.name").alias("city"),
        F.col("payload.main.temp").alias("temperature"),
        F.col("payload.main.humidity").alias("humidity"),
        weather["main"].alias("condition"),
        weather["description"].alias("description"),
        F.col("payload.wind.speed").alias("wind_speed"),
        S.is_rain(weather["main"]).alias("is_rainy"),
    )
