import json
import os

import pytest
from pyspark.sql import functions as F

from pricetide.operators.prices import keep_last
from pricetide.sources import captures, publish, readers, writers
from pricetide.session import materialise, scratch_dir
from tests.frames import at, conditions, observations, rows


def test_price_files(spark, folder):
    with open(f"{folder}/prices.csv", "w", encoding="utf-8") as f:
        f.write("restaurant,category,item_name,price,scraped_at,scrape_session_id\n")
        f.write('A,rolls,"Roll, egg",₹120,2024-01-01 10:05,20240101_1000\n')
        f.write("A,rolls,Tea,free,2024-01-01 10:05,20240101_1000\n")
        f.write("A,,Tea,₹10,yesterday,\n")
    cleaned = readers.clean_prices(readers.read_prices_csv(spark, f"{folder}/prices.csv"))
    good = readers.accepted_prices(cleaned).head()
    assert (good["entity"], good["item"], good["price"]) == ("A", "Roll, egg", 120)
    assert good["observed_at"] == at("2024-01-01 10:05")
    assert readers.rejected_prices(cleaned).count() == 2


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_order_within_a_minute_is_that_of_the_files(spark, folder, zone):
    files = {"b.csv": [120, 90, 130], "a.csv": [100, 140, 80, 110]}
    for name, seen in files.items():
        with open(f"{folder}/{name}", "w") as out:
            out.write("restaurant,category,item_name,price,scraped_at,scrape_session_id\n")
            out.writelines(f"Inn,Mains,Rice,{p},2024-03-31 02:30,s\n" for p in seen)
            out.write("Inn,Mains,Rice,100,2024-03-31,s\nInn,Mains,Rice,100,2024-02-30 10:00,s\n")
    before = spark.conf.get("spark.sql.session.timeZone")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        cleaned = readers.clean_prices(readers.read_prices_csv(spark, folder))
        got = readers.accepted_prices(cleaned).orderBy("ordinal").collect()
        assert readers.rejected_prices(cleaned).count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [r.price for r in got] == [100, 140, 80, 110, 120, 90, 130]
    # An hour that the zone's clocks skip is kept as written.
    assert {str(r.observed_at) for r in got} == {"2024-03-31 02:30:00"}


@pytest.mark.parametrize("header", [True, False])
def test_condition_files(spark, folder, header):
    with open(f"{folder}/weather.csv", "w", encoding="utf-8") as f:
        if header:
            f.write("city,temperature,humidity,condition,description,wind_speed,is_rainy,"
                    "recorded_at,scrape_session_id\n")
        f.write("Town,27.04,64,Rain,moderate rain,8.93,True,2024-01-01 10:05,20240101_1000\n")
        f.write("Town,37.7,40,Clear,clear sky,2.0,False,2024-01-01 12:00,20240101_1200\n")
    got = readers.read_conditions_csv(spark, f"{folder}/weather.csv", header).collect()
    assert [(r["temperature"], r["is_rainy"]) for r in got] == [(27.04, True), (37.7, False)]
    assert got[0]["recorded_at"] == at("2024-01-01 10:05")


def test_run_log(spark, folder):
    path = f"{folder}/state.json"
    assert readers.read_run_log(spark, path).count() == 0
    entry = {"status": "success", "session_id": "s", "time": "t", "duration_minutes": 24}
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"last_status": "success", "recent_logs": [entry, entry]}, f, indent=2)
    assert readers.read_run_log(spark, path).count() == 2
    with open(path, "w", encoding="utf-8") as f:
        f.write("{broken")
    assert readers.read_run_log(spark, path).count() == 0


def test_status_of_run_log_files(spark, folder):
    entry = {"status": "success", "session_id": "s2", "time": "t", "duration_minutes": 24}
    os.makedirs(f"{folder}/logs/a")
    for name, text in {
        "a/x": json.dumps({"last_status": "failed", "last_session_id": "s3", "last_scrape_time": "t3",
                           "last_duration_minutes": 3, "restaurants_scraped": 19, "last_error_type": "timeout",
                           "recent_logs": [entry, entry, {**entry, "status": "failed"}]}, indent=2),
        "y": json.dumps({"last_status": "success", "recent_logs": []}),
        "z": json.dumps({"last_status": "success"}),
        "broken": "{broken",
        "blank": " \n",
    }.items():
        with open(f"{folder}/logs/{name}.json", "w", encoding="utf-8") as f:
            f.write(text)
    got = {tuple(r)[0]: tuple(r)[1:] for r in readers.run_status_files(spark, f"{folder}/logs", "/([a-z]+).json").collect()}
    assert got == {
        "x": ("ok", "failed", "s3", "t3", 3, 19, "timeout", 3, 2),
        "y": ("ok", "success", None, None, None, None, None, 0, 0),
        "z": ("ok", "success", None, None, None, None, None, 0, 0),
        "broken": ("broken", *[None] * 8),
        "blank": ("empty", *[None] * 8),
    }


def test_appended_conditions_and_older_files(spark, folder):
    readings = conditions(spark, [("s1", True, 20.0, "2024-01-01 10:00"), ("s2", False, 25.0, "2024-01-02 10:00")])
    path = f"{folder}/conditions"
    assert not writers.append_batch(readings.limit(0), path, "recorded_at")
    for _ in range(2):
        assert writers.append_batch(readings, path, "recorded_at")
    assert spark.read.parquet(path).where("obs_date = '2024-01-02'").count() == 2
    readings.drop("temperature").write.parquet(f"{folder}/grown/part=1")
    readings.write.parquet(f"{folder}/grown/part=2")
    grown = readers.read_grown_table(spark, f"{folder}/grown")
    assert rows(grown, "session_id", "temperature") == rows(
        readings.select("session_id", "temperature").union(readings.selectExpr("session_id", "cast(null as double)"))
    )


def test_faults_of_pages(spark):
    deep = '{"name": "top", "price": 5, "rest": [[[{"name": "low", "price": 7}]]]}'
    states = {0: deep, 1: '{"name": "cut"', 2: '{"name": "dear", "price": 1e400}', 3: '[{"name": "a", "price": true}]'}
    pages = spark.createDataFrame(list(states.items()), "page_id long, state string").select(
        "page_id", captures.embed_state(F.lit("<html>"), F.col("state")).alias("html")
    )
    pages = pages.union(spark.createDataFrame([(4, "<html>"), (5, None)], "page_id long, html string"))
    assert rows(captures.walk_pages(pages, max_depth=3)) == sorted(
        [(0, 0, "top", 5, None), (0, None, None, None, "depth"), (1, None, None, None, "state"),
         (2, None, None, None, "price")], key=repr)
    assert rows(captures.extract_prices(pages)) == [(0, 0, "top", 5), (0, 1, "low", 7)]


def test_append_and_backfill(spark, folder):
    new = observations(spark, [("a", "c", "x", 1, "2024-01-01 10:00", "s1"),
                               ("a", "c", "x", 2, "2024-01-02 10:00", "s2")])
    path = f"{folder}/prices"
    assert not writers.append_batch(new.limit(0), path)
    assert not os.path.exists(path)
    assert writers.append_batch(new, path) and writers.append_batch(new, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and "obs_date" in stored.columns
    assert sorted(x for x in os.listdir(path) if "=" in x) == [
        "obs_date=2024-01-01", "obs_date=2024-01-02",
    ]
    old = readers.with_missing_columns(new.drop("session_id"), new.schema)
    assert old.columns == new.columns
    assert {r["session_id"] for r in old.unionByName(new).collect()} == {None, "s1", "s2"}


def test_queries_and_tables(spark):
    frame = spark.range(5).withColumnRenamed("id", "n")
    writers.replace_table(frame, "replaced_table")
    writers.replace_table(frame.limit(2), "replaced_table")
    got = readers.read_query(spark, "SELECT * FROM replaced_table WHERE n >= :least", least=1)
    assert got.count() == 1
    spark.sql("DROP TABLE replaced_table")


def test_export(spark, folder):
    written = writers.export_csv({"one": spark.range(3), "two": spark.range(2)}, folder)
    assert spark.read.option("header", True).csv(written["one"]).count() == 3


def test_conform(spark):
    frame = spark.createDataFrame([("a", 1)], "restaurant string, other int")
    assert readers.conform(frame, readers.PRICE_NAMES).columns == ["entity", "other"]


def test_publish_is_all_or_nothing(spark, folder):
    one, two = spark.range(1), spark.range(2)
    with pytest.raises(LookupError):
        publish.read_published(spark, folder, "a")
    publish.publish_set(spark, {"a": one, "b": one}, folder)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        publish.publish_set(spark, {"a": two, "b": broken}, folder)
    assert publish.read_published(spark, folder, "a").count() == 1
    run = publish.publish_set(spark, {"a": two, "b": two}, folder, run_id="r2")
    assert publish.publish_set(spark, {"a": one, "b": one}, folder, run_id="r2") == run
    assert publish.read_published(spark, folder, "a").count() == 2
    assert publish.current_run(spark, folder)["version"] == 2


def test_a_run_is_never_published_again(spark, folder):
    one, two = spark.range(1), spark.range(2)
    publish.publish_set(spark, {"a": one}, folder, run_id="one")
    publish.publish_set(spark, {"a": two}, folder, run_id="two")
    publish.publish_set(spark, {"a": spark.range(3)}, folder, run_id="one")
    assert publish.current_run(spark, folder)["run_id"] == "two"
    assert spark.read.parquet(f"{folder}/run_id=one/a").count() == 1
    assert publish.expire(spark, folder, keep=1) == ["one"]
    assert publish.read_published(spark, folder, "a").count() == 2
    publish.publish_set(spark, {"a": one}, folder, run_id="one")
    assert publish.current_run(spark, folder)["run_id"] == "two"


def test_publishers_at_the_same_time_get_different_versions(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: publish.publish_set(spark, {"a": spark.range(n)}, folder), range(1, 5)))
    versions = [r["version"] for r in spark.read.parquet(f"{folder}/manifest").collect()]
    assert len(versions) == 4 == len(set(versions))


def test_materialise_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root)
    again = materialise(spark.range(4), "x")
    assert again.count() == 4 and again.inputFiles()[0].startswith(f"file:{root}") or (
        again.inputFiles()[0].startswith(f"file://{root}")
    )


def page(state: str) -> str:
    literal = json.dumps(state)[1:-1]
    return f'<html>\n<script>window.__PRELOADED_STATE__ = JSON.parse("{literal}");</script></html>'


def nested(depth):
    node = {"name": "deep", "price": 1}
    for _ in range(depth):
        node = [node]
    return node


def test_extraction(spark):
    states = {
        1: {
            "name": "parent", "price": 10.9,
            "items": [{"Title": "häuser", "COST": 3}, {"name": "p", "price": 0},
                      {"name": "n", "price": -1}, {"name": "t", "price": True},
                      {"name": "s", "price": "4"}, {"name": "", "price": 4}],
        },
        2: {"a": {"name": "first", "title": "second", "price": 5, "cost": 6}},
        3: nested(15),
        4: nested(16),
        5: {"a": [{"name": "x", "price": 1}, {"name": "y", "price": 2}, {"name": "x", "price": 3}]},
    }
    pages = spark.createDataFrame(
        [(k, page(json.dumps(v))) for k, v in states.items()]
        + [(6, "<html>no state</html>"), (7, page("{broken")), (8, None)],
        "page_id long, html string",
    )
    got = captures.extract_prices(pages)
    assert rows(got, "page_id", "ordinal", "item", "price") == [
        (1, 0, "parent", 10), (1, 1, "häuser", 3), (2, 0, "second", 6), (3, 0, "deep", 1),
        (5, 0, "x", 1), (5, 1, "y", 2), (5, 2, "x", 3),
    ]
    last = keep_last(got, ["page_id", "item"], "ordinal")
    assert rows(last.where("page_id = 5"), "item", "price") == [("x", 3), ("y", 2)]


def test_weather_payloads(spark):
    body = {
        "main": {"temp": 27.5, "humidity": 64}, "name": "Town", "wind": {"speed": 2.1},
        "weather": [{"main": "Drizzle", "description": "light drizzle"}, {"main": "Clear"}],
    }
    frame = spark.createDataFrame(
        [("s1", json.dumps(body)), ("s2", "{}")], "session_id string, body string"
    )
    got = captures.flatten_weather(frame).orderBy("session_id").collect()
    assert tuple(got[0]) == ("s1", "Town", 27.5, 64, "Drizzle", "light drizzle", 2.1, True)
    assert tuple(got[1])[1:] == (None,) * 7


def test_exported_files_are_compressed(spark, folder):
    written = writers.export_csv({"one": spark.range(1000)}, folder)["one"]
    files = [f["f"] for f in spark.read.option("header", True).csv(written).selectExpr("input_file_name() AS f").distinct().collect()]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert spark.read.option("header", True).csv(written).count() == 1000
