import pytest
from pyspark.sql import functions as F

from pricetide.config import IndexRules
from pricetide.operators import hourly, metrics, pricing_index
from tests import goldens
from tests.frames import base, changes, rows


@pytest.fixture(scope="module")
def cells(spark):
    """The known hourly cells unfolded to one event each of the mean change."""
    seen = base(spark, [(e, "c", "Momo", h) for e in goldens.CELLS for h in range(10, 23)])
    events = changes(
        spark,
        [
            {"entity": e, "hour_of_day": h, "pct_change": mean}
            for e, hours in goldens.CELLS.items()
            for h, (n, mean) in hours.items()
            for _ in range(n)
        ],
    )
    return seen, events


def test_known_hourly_totals(cells):
    for r in hourly.hourly_overall(*cells).collect():
        events, mean = goldens.OVERALL[r["hour_of_day"]]
        assert r["total_change_events"] == events
        assert r["avg_price_change_pct"] == pytest.approx(mean, abs=0.011)


def test_known_windows(cells):
    got = {(r["entity"], r["time_window"]): r for r in hourly.peak_offpeak(*cells).collect()}
    assert len(got) == len(goldens.CELLS) * 5
    for key, r in got.items():
        events, mean = goldens.WINDOWS.get(key, (0, 0.0))
        assert r["total_change_events"] == events
        assert r["avg_price_change_pct"] == pytest.approx(mean, abs=0.011)


def test_known_peaks(cells):
    got = {r["entity"]: r for r in hourly.hourly_peak(*cells).collect()}
    for entity, (hour, value) in goldens.PEAKS.items():
        assert (got[entity]["peak_hour"], got[entity]["peak_change_pct"]) == (hour, value)
    # only falling prices: the first hour without a change is the peak
    assert (got["mughlai"]["peak_hour"], got["mughlai"]["peak_change_pct"]) == (10, 0.0)


def test_event_counts_agree_between_tables(cells):
    def total(frame):
        return frame.agg(F.sum("total_change_events")).head()[0]

    stability = metrics.stability_score(*cells).agg(F.sum("price_change_events")).head()[0]
    assert (
        stability
        == total(hourly.hourly_overall(*cells))
        == total(hourly.hourly_per_entity(*cells))
        == total(hourly.peak_offpeak(*cells))
        == 486
    )


def test_known_volatility(spark):
    seen = base(spark, [(f"e{i:02d}", "c", "Momo", 1) for i in range(len(goldens.EVENTS))])
    events = changes(
        spark, [{"entity": f"e{i:02d}"} for i, (n, _) in enumerate(goldens.EVENTS) for _ in range(n)]
    )
    got = rows(metrics.stability_score(seen, events), "entity", "price_change_events", "pvs_normalized")
    assert got == [(f"e{i:02d}", n, v) for i, (n, v) in enumerate(goldens.EVENTS)]


def test_known_index(spark):
    known = [(f"e{i:02d}", "c", *g[:4]) for i, g in enumerate(goldens.INDEX)]
    components = spark.createDataFrame(
        known,
        "entity string, category string, rpi double, wpi double, temp_effect double,"
        " pvs_normalized double",
    )
    got = rows(
        pricing_index.score_components(components), "entity", "dpi", "dpi_rank", "pricing_behavior"
    )
    assert got == [(f"e{i:02d}", *g[4:]) for i, g in enumerate(goldens.INDEX)]


def test_index_from_tables_equals_index_from_profile(cells):
    tables = pricing_index.components_from_tables(
        metrics.stability_score(*cells),
        metrics.rain_premium(*cells),
        metrics.weekend_premium(*cells),
        metrics.temperature_effect(*cells),
    )
    assert rows(pricing_index.score_components(tables)) == rows(
        pricing_index.dynamic_pricing_index(*cells)
    )


@pytest.mark.parametrize("mode", ["capped", "zscore", "minmax"])
def test_index_stays_in_range(cells, mode):
    for r in pricing_index.dynamic_pricing_index(*cells, IndexRules(mode=mode)).collect():
        assert 0 <= r["dpi"] <= 100


def test_index_weights_are_checked():
    with pytest.raises(ValueError):
        IndexRules(rain_weight=0.3)
    with pytest.raises(ValueError):
        IndexRules(mode="other")


def test_no_events_at_all(spark):
    seen = base(spark, [("a", "c", "Momo", 1), ("b", "c", "Other", 2)])
    none = changes(spark, [])
    assert rows(metrics.stability_score(seen, none)) == [
        ("a", "c", 0, 0.0, 0.0, 0.0), ("b", "c", 0, 0.0, 0.0, 0.0),
    ]
    assert rows(metrics.rain_premium(seen, none))[0][2:] == (
        0, 0, 0.0, 0.0, 0.0, False, "No significant change",
    )
    assert rows(metrics.category_sensitivity(seen, none)) == [("Momo", 0, 0.0, 0.0, 0.0)]
    assert rows(pricing_index.dynamic_pricing_index(seen, none), "dpi", "dpi_rank") == [
        (0.0, 1), (0.0, 1),
    ]
    assert len(rows(hourly.hourly_per_entity(seen, none))) == 4


def test_unknown_flags_count_for_neither_side(spark):
    seen = base(spark, [("a", "c", "Momo", 1)])
    events = changes(
        spark, [{"is_rainy": None}, {"is_rainy": True, "pct_change": 4.0}, {"is_rainy": False}]
    )
    got = metrics.rain_premium(seen, events).head()
    assert (got["rainy_records"], got["clear_records"], got["rpi"]) == (1, 1, 4.0)


def test_one_event_has_no_deviation(spark):
    seen = base(spark, [("a", "c", "Momo", 1)])
    assert metrics.stability_score(seen, changes(spark, [{}])).head()["cv_pct"] == 0.0


def test_verdict_thresholds(spark):
    seen = base(spark, [(e, "c", "Momo", 1) for e in ("four", "five", "down")])
    events = changes(
        spark,
        [{"entity": "four", "is_rainy": True}] * 4
        + [{"entity": "five", "is_rainy": True}] * 5
        + [{"entity": "down", "is_rainy": True, "pct_change": -1.0}] * 5,
    )
    got = {r["entity"]: (r["significant"], r["verdict"]) for r in
           metrics.rain_premium(seen, events).collect()}
    assert got == {
        "four": (False, "No significant change"),
        "five": (True, "Surge confirmed"),
        "down": (True, "Drop during rain"),
    }


def test_temperature_needs_hot_or_cool(spark):
    seen = base(spark, [("a", "c", "Momo", 1)])
    cool = changes(spark, [{"temperature_band": "Cool"}] * 3)
    got = metrics.temperature_effect(seen, cool).head()
    # significant by count, but without a hot change there is no direction
    assert (got["significant"], got["verdict"]) == (True, "No significant change")


def test_uplift_is_optional(spark):
    seen = base(spark, [("a", "c", "Momo", 1)])
    events = changes(
        spark, [{"is_rainy": True, "pct_change": 4.0}, {"is_rainy": False, "pct_change": 1.5}]
    )
    assert "rpi_uplift" not in metrics.rain_premium(seen, events).columns
    assert metrics.rain_premium(seen, events, uplift=True).head()["rpi_uplift"] == 2.5


def test_unlabelled_entities_have_no_events_and_no_index(spark):
    seen = base(spark, [("a", None, "Momo", 1), ("b", "c", "Momo", 1)])
    events = changes(spark, [{"entity": "a", "category": None}, {"entity": "b"}])
    assert rows(metrics.stability_score(seen, events), "entity", "price_change_events") == [
        ("a", 0), ("b", 1),
    ]
    assert rows(pricing_index.dynamic_pricing_index(seen, events), "entity") == [("b",)]
    # hours are matched without the category
    assert hourly.hourly_overall(seen, events).head()["total_change_events"] == 2
