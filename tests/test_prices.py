import pytest

from pricetide.operators import prices
from tests.frames import conditions, observations, rows


@pytest.fixture(scope="module")
def seen(spark):
    return observations(
        spark,
        [
            ("a", "c", "x", 10, "2024-01-01 10:00", "s1"),
            ("a", "c", "x", 20, "2024-01-02 12:00", "s2"),
            ("a", "d", "x", 30, "2024-01-02 12:00", "s2"),
            ("a", "c", "y", 41, "2024-01-03 23:00", "s3"),
            ("b", "c", "x", 50, "2024-01-09 22:00", None),
            ("b", "c", "x", 60, "2024-01-09 09:59", "gone"),
        ],
    )


@pytest.fixture(scope="module")
def readings(spark):
    return conditions(
        spark,
        [
            ("s1", True, 20.0, "2024-01-01 10:00"),
            ("s2", False, 30.0, "2024-01-02 12:00"),
            ("s2", False, 31.0, "2024-01-02 12:01"),
            ("s3", None, 40.0, "2024-01-03 23:00"),
            (None, True, 1.0, "2024-01-03 23:00"),
        ],
    )


def test_condition_prices_fan_out_on_repeated_sessions(seen, readings):
    # the two prices of s2 count twice; an unknown flag is dry
    assert rows(prices.entity_condition_price(seen, readings)) == [
        ("a", "Dry", 28.0, 5), ("a", "Rain", 10.0, 1),
    ]
    assert rows(prices.market_condition_price(seen, readings)) == [("Dry", 28.0, 5), ("Rain", 10.0, 1)]


def test_heatmap_hours(seen):
    assert rows(prices.category_hour_heatmap(seen)) == [
        ("c", 10, 10.0, 1), ("c", 12, 20.0, 1), ("c", 22, 50.0, 1), ("d", 12, 30.0, 1),
    ]


def test_bands_use_one_reading(seen, readings):
    assert rows(prices.band_summary(seen, readings)) == [
        ("Cool", 1, 20.0, 20.0, 10.0, 0.0),
        ("Hot", 1, 40.0, 40.0, 41.0, 0.0),
        ("Normal", 2, 31.0, 31.0, 25.0, 7.07),
    ]
    assert rows(prices.entity_band_price(seen, readings), "entity", "category", "temperature_band",
                "total_records") == [
        ("a", "c", "Cool", 1), ("a", "c", "Hot", 1), ("a", "c", "Normal", 1), ("a", "d", "Normal", 1),
    ]


def test_latest_price_ignores_the_category(seen):
    got = rows(prices.latest_prices(seen), "entity", "item", "category", "price")
    assert got == [("a", "x", "d", 30.0), ("a", "y", "c", 41.0), ("b", "x", "c", 50.0)]


def test_history_counts_back_from_the_newest_row_of_all(seen):
    assert prices.price_history(seen, 7, "a").count() == 1
    assert prices.price_history(seen, 8, "a").count() == 3
    assert prices.price_history(seen, 30).columns[0] == "entity"
    day = prices.price_history(seen, 1, "b").head()
    assert (day["avg_price"], day["min_price"], day["max_price"], day["observations_that_day"]) == (
        55.0, 50.0, 60.0, 2,
    )
    ordered = prices.history_in_order(prices.price_history(seen, 30, "a")).collect()
    assert [r["history_date"].day for r in ordered] == [3, 2, 2, 1]


@pytest.mark.parametrize("days", [0, 31, -1])
def test_history_bounds(seen, days):
    with pytest.raises(ValueError):
        prices.price_history(seen, days)


def test_listing(spark, seen):
    index = spark.createDataFrame([("a", "c"), ("a", "d")], "entity string, category string")
    assert rows(prices.entity_listing(seen, index)) == rows(
        spark.createDataFrame(
            [("a", "c", 1, 4), ("a", "d", 1, 4), ("b", None, 1, 2)],
            "entity string, category string, n long, p long",
        )
    )


def test_keep_last(spark):
    frame = spark.createDataFrame(
        [("s", "x", 1, 5), ("s", "x", 3, 7), ("s", "x", 2, 6), ("s", None, 1, 9)],
        "session string, item string, ordinal int, price int",
    )
    got = rows(prices.keep_last(frame, ["session", "item"], "ordinal"))
    assert sorted(got, key=repr) == sorted([("s", "x", 3, 7), ("s", None, 1, 9)], key=repr)


def test_only_sums_are_shuffled(seen, readings):
    """Below every exchange of observations there is an aggregate."""
    for table in (
        prices.entity_condition_price(seen, readings),
        prices.market_condition_price(seen, readings),
        prices.entity_band_price(seen, readings),
    ):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        join = plan.index("Join")
        assert plan.index("sum(price", join) and "Aggregate" in plan[join:]
    shuffled = prices.entity_condition_price(seen, readings)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in shuffled.splitlines() if "Exchange hashpartitioning(entity" in x or "partial_sum(price" in x]
    assert any("partial_sum(price" in x for x in lines)
