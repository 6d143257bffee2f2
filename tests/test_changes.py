import random

import pytest
from pyspark.sql import functions as F

from pricetide.config import ChangeRules, SkewRules
from pricetide.operators import changes as C
from tests.frames import conditions, observations, rows

CUT = SkewRules(hot_rows=20, rows_per_slice=5)


def prices(spark, *steps):
    """One item with (price, time) steps."""
    return observations(spark, [("e", "c", "i", p, t, "s") for p, t in steps])


def found(frame):
    return [(r["prev_price"], r["new_price"]) for r in frame.orderBy("ordinal").collect()]


@pytest.mark.parametrize(
    "prev, new, gap, valid",
    [
        (100, 130, "06:00", True),      # exactly 30 %, exactly 6 h
        (100, 131, "06:00", False),
        (100, 110, "06:01", False),
        (400, 450, "02:00", True),      # exactly 50
        (400, 451, "02:00", False),
        (400, 350, "02:00", True),
        (50, 60, "02:00", False),       # the limit itself is excluded
        (51, 60, "02:00", True),
        (60, 50, "02:00", False),
        (100, 100, "02:00", False),
    ],
)
def test_documented_filter(spark, prev, new, gap, valid):
    frame = prices(spark, (prev, "2024-01-01 00:00"), (new, f"2024-01-01 {gap}"))
    assert found(C.change_events(frame)) == ([(prev, new)] if valid else [])


def test_limits_can_be_switched_off(spark):
    frame = prices(spark, (1, "2024-01-01 00:00"), (1000, "2024-03-01 00:00"), (0, "2024-03-02 00:00"),
                   (7, "2024-03-03 00:00"))
    none = ChangeRules(None, None, None, None)
    # a change from zero has no percentage
    assert found(C.change_events(frame, none)) == [(1, 1000), (1000, 0)]


def test_first_price_null_price_and_ties(spark):
    frame = observations(
        spark,
        [
            ("e", "c", "i", 100.0, "2024-01-01 10:00", "s"),
            ("e", "c", "i", 110.0, "2024-01-01 10:00", "s"),
            ("e", "c", "i", None, "2024-01-01 11:00", "s"),
            ("e", "c", "i", 120.0, "2024-01-01 12:00", "s"),
            ("e", None, "i", 100.0, "2024-01-01 10:00", "s"),
            ("e", None, "i", 105.0, "2024-01-01 11:00", "s"),
        ],
    )
    assert found(C.change_events(frame)) == [(100.0, 110.0), (100.0, 105.0)]


def test_conditions_of_the_newer_session(spark):
    frame = observations(
        spark,
        [
            ("e", "c", "chicken momo", 100.0, "2024-01-06 10:00", "s1"),
            ("e", "c", "chicken momo", 110.0, "2024-01-06 12:00", "s2"),
            ("e", "c", "chicken momo", 120.0, "2024-01-06 14:00", "s3"),
            ("e", "c", "chicken momo", 130.0, "2024-01-06 16:00", None),
        ],
    )
    readings = conditions(
        spark,
        [
            ("s1", False, 20.0, "2024-01-06 10:00"),
            ("s2", False, 20.0, "2024-01-06 12:00"),
            ("s2", True, 35.0, "2024-01-06 12:01"),  # the later reading counts
            (None, True, 35.0, "2024-01-06 12:01"),
        ],
    )
    got = C.price_changes(frame, readings)
    assert rows(got, "new_price", "is_rainy", "temperature_band", "dish_type", "is_weekend") == [
        (110.0, True, "Hot", "Momo", True),
        (120.0, None, None, "Momo", True),
        (130.0, None, None, "Momo", True),
    ]
    assert C.analysis_base(frame, readings).count() == 4


def test_empty_input(spark):
    empty = observations(spark, [])
    assert C.price_changes(empty, conditions(spark, [])).count() == 0


def skewed(spark, n=400):
    """One item holds most rows, several rows share a time, another item is large too."""
    chance = random.Random(5)
    data = []
    for k in range(n):
        item = chance.choice(["hot"] * 6 + ["warm"] * 2 + ["a", "b", None])
        minute = chance.randrange(0, 600)
        data.append(
            ("e", chance.choice(["c", None]), item, float(chance.randrange(1, 90)),
             f"2024-01-0{1 + minute // 120} {minute % 24:02d}:{minute % 60:02d}", "s")
        )
    # an outlier, and rows without a time
    data += [("e", "c", "hot", 5.0, "1990-01-01 00:00", "s")]
    timed = observations(spark, data)
    return timed.withColumn("observed_at", F.expr("CASE WHEN ordinal % 50 <> 7 THEN observed_at END"))


def test_sliced_previous_price_equals_plain_window(spark):
    frame = skewed(spark)
    sliced = C.with_previous(frame, rules=CUT)
    plain = spark.sql(
        "SELECT *, lag(price) OVER w AS prev_price, lag(observed_at) OVER w AS prev_at FROM {f}"
        " WINDOW w AS (PARTITION BY entity, category, item ORDER BY observed_at, ordinal)",
        f=frame,
    )
    columns = ("ordinal", "prev_price", "prev_at")
    assert rows(sliced, *columns) == rows(plain, *columns)


def test_hot_items_really_are_cut(spark):
    from pricetide.functions import scalars as S
    from pricetide.operators import skew

    timed = skewed(spark).withColumn("_at", S.epoch_micros("observed_at"))
    cut = skew.add_slices(timed, C.ITEM_KEYS, "_at", CUT)
    per_item = {
        (r["category"], r["item"]): r["n"]
        for r in cut.groupBy("category", "item").agg(F.count_distinct("_slice").alias("n")).collect()
    }
    assert per_item[("c", "hot")] > 5 and per_item[(None, "hot")] > 5
    sizes = cut.where("_slice is not null").groupBy("category", "item", "_slice", "_at").count()
    per_slice = sizes.groupBy("category", "item", "_slice").agg(F.sum("count").alias("n"), F.count("*").alias("times"))
    # equal times stay together, and rows without a time are all in the first slice
    assert all(r["n"] <= 2 * 5 + 4 or r["times"] == 1 or r["_slice"] == 0 for r in per_slice.collect())
    assert cut.where("_at is null and _slice > 0").count() == 0
    whole = cut.where("_slice is null").groupBy("category", "item").count()
    assert whole.where("count >= 20").count() == 0


def test_events_and_spine(spark):
    from tests.frames import base, changes

    events = changes(spark, [{"entity": "a"}, {"entity": "a", "category": None}])
    seen = base(spark, [("a", "c", "Momo", 1), ("a", None, "Momo", 1), ("b", "c", "Roll", 2)])
    got = (
        C.events_and_spine(seen, events, "entity", "category")
        .groupBy("entity", "category")
        .agg(F.count("is_event").alias("n"))
    )
    assert rows(got) == rows(
        spark.createDataFrame(
            [("a", "c", 1), ("a", None, 0), ("b", "c", 0)], "entity string, category string, n long"
        )
    )


def test_gap_uses_full_precision(spark):
    frame = prices(spark, (100, "2024-01-01 00:00:00.000001"), (110, "2024-01-01 06:00:00.000001"))
    assert len(found(C.change_events(frame))) == 1
    frame = prices(spark, (100, "2024-01-01 00:00:00.000001"), (110, "2024-01-01 06:00:00.000002"))
    assert found(C.change_events(frame)) == []
