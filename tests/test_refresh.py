import os

from pricetide.operators import metrics
from pricetide.plans import catalog, reads
from pricetide.plans.adapters import RELAXED
from pricetide.plans.refresh import metric_tables, refresh
from pricetide.sources.publish import current_run, read_published
from tests.frames import rows

SF_DIR = "/root/testdata/sf0.001"


def test_all_fifteen_tables_equal_the_single_queries(spark, folder):
    m = catalog.market(spark, SF_DIR)
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    refresh(spark, m.observations, m.conditions, folder, RELAXED)
    assert set(os.listdir(root)) == before
    names = current_run(spark, folder)["tables"]
    assert len(names) == 15
    for name in names:
        assert rows(read_published(spark, folder, name)) == rows(
            catalog.QUERIES[name](spark, SF_DIR)
        ), name


def test_documented_rules_by_default(spark):
    m = catalog.market(spark, SF_DIR)
    tables = metric_tables(m.observations, m.conditions)
    strict = catalog.price_changes_strict(spark, SF_DIR).count()
    assert sum(r["price_change_events"] for r in tables["stability_score"].collect()) == strict


def test_summary_with_one_or_no_entity(spark):
    index = spark.createDataFrame(
        [("a", "c", 0.0, 0.0, 6.0, 0.0, 12.34, 1, "Static Pricer")],
        "entity string, category string, rpi double, wpi double, temp_effect double,"
        " pvs_normalized double, dpi double, dpi_rank int, pricing_behavior string",
    )
    weekend = spark.createDataFrame(
        [("a", "c", 1.5)], "entity string, category string, avg_change_weekend double"
    )
    got = reads.market_summary(index, weekend).head()
    assert (got["entities"], got["static_share_pct"], got["temperature_sensitive"]) == (1, 100.0, 1)
    assert (got["top_entity"], got["top_index"], got["second_entity"]) == ("a", 12.3, None)
    assert got["second_weekend_change"] == "N/A"
    empty = reads.market_summary(index.limit(0), weekend).head()
    assert (empty["entities"], empty["static_share_pct"], empty["top_entity"]) == (0, None, None)


def test_ordered_reads(spark):
    index = catalog.rankings_read(spark, SF_DIR).collect()
    assert [r["dpi_rank"] for r in index] == sorted(r["dpi_rank"] for r in index)
    rain = [r["rpi"] for r in catalog.rain_read(spark, SF_DIR).collect()]
    assert rain == sorted(rain, reverse=True)
    m = catalog.market(spark, SF_DIR)
    assert metrics.weekend_premium(m.base, m.changes).count() == len(rain)
    pairs = [r["correlation"] for r in reads.pairs_read(catalog.sync_pairs_all(spark, SF_DIR)).collect()]
    assert pairs == sorted(pairs, reverse=True)
