import random

import pytest
from pyspark.sql import functions as F

from pricetide.config import ChangeRules
from pricetide.operators import changes as C
from pricetide.streaming import admission, sinks, sources
from pricetide.streaming import operators as ops
from tests.frames import conditions, observations, rows

RULES = ChangeRules(None, None, None, 6 * 3600)
COLUMNS = ("ordinal", "entity", "category", "item", "prev_price", "new_price", "observed_at")


def write_parts(frame, folder, column="ordinal", parts=4, size=50):
    """One file per range of ordinals, in order."""
    for n in range(parts):
        part = frame.where(F.col(column).between(n * size, (n + 1) * size - 1))
        part.coalesce(1).write.mode("append").parquet(folder)


def stream_of(spark, frame, folder):
    return (
        spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    )


def changes_of(spark, frame, folder, delay="6 hours"):
    """Change events of the files below ``in``, all of which are there."""
    admission.close(spark, f"{folder}/in", frame.schema)
    changes = ops.stream_changes(stream_of(spark, frame, f"{folder}/in"), RULES, delay)
    sinks.run_available(changes, f"{folder}/out", f"{folder}/check")
    return sinks.read_batches(spark, f"{folder}/out", changes.schema)


@pytest.fixture(scope="module")
def day(spark):
    chance = random.Random(2)
    minutes = sorted(chance.randrange(0, 3 * 24 * 60) for _ in range(200))
    return observations(
        spark,
        [
            ("e", chance.choice(["c", None]), chance.choice("xxxyz"),
             chance.choice([90, 100, 110, 120]),
             f"2024-01-0{1 + m // 1440} {m % 1440 // 60:02d}:{m % 60:02d}", f"s{m // 120}")
            for m in minutes
        ],
    )


@pytest.mark.parametrize("files, ordered", [(1, True), (4, True), (4, False), (16, False)])
def test_results_do_not_depend_on_the_batches(spark, day, folder, files, ordered):
    """In the order of times, or dealt out by a hash with a delay as long as the disorder."""
    key = F.floor(F.col("ordinal") / (200 / files)) if ordered else F.pmod(F.hash("ordinal"), F.lit(files))
    split = day.withColumn("k", key)
    for n in range(files):
        split.where(F.col("k") == n).drop("k").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    delay = "6 hours" if ordered else "4 days"
    first = ops.stream_dedupe(stream_of(spark, day, f"{folder}/in"), delay)
    sinks.run_available(first, f"{folder}/first", f"{folder}/check-first")
    got = sinks.read_batches(spark, f"{folder}/first", first.schema)
    assert rows(got, "session_id", "entity", "item") == rows(day.select("session_id", "entity", "item").distinct())

    got = changes_of(spark, day, folder, delay)
    want = C.change_events(day, RULES)
    assert rows(got, *COLUMNS) == rows(want, *COLUMNS) and len(rows(got)) > 50

    # the files of one batch come in any order, and a batch holds what had waited
    windows = ops.stream_hourly(sources.stream_table(spark, f"{folder}/out/*/*", got.schema, 1), "8 days")
    sinks.run_available(windows, f"{folder}/hours", f"{folder}/check-hours", "update")
    latest = sinks.read_latest(spark, f"{folder}/hours", windows.schema, ["window_start"])
    by_hour = want.groupBy(F.date_trunc("hour", "observed_at").cast("timestamp_ntz").alias("w")).agg(
        F.count("*").alias("n")
    )
    assert rows(latest, "window_start", "events") == rows(by_hour)


def test_rows_late_within_the_delay_are_included(spark, folder):
    frame = observations(
        spark,
        [
            ("e", "c", "x", 100, "2024-01-01 10:00", "s"),
            ("e", "c", "x", 110, "2024-01-01 12:00", "s"),
            ("e", "c", "x", 90, "2024-01-01 11:00", "s"),
            ("e", "c", "x", 120, "2024-01-01 13:00", "s"),
        ],
    )
    write_parts(frame, f"{folder}/in", parts=2, size=2)
    got = changes_of(spark, frame, folder)
    assert rows(got, "prev_price", "new_price") == [(100.0, 90.0), (110.0, 120.0), (90.0, 110.0)]


def test_later_rows_are_counted_or_kept_apart(spark, folder):
    frame = observations(
        spark,
        [
            ("e", "c", "x", 100, "2024-01-01 10:00", "s"),
            ("e", "c", "x", 110, "2024-01-03 12:00", "s"),
            ("e", "c", "x", 120, "2024-01-03 13:00", "s"),
            ("e", "c", "x", 90, "2024-01-01 11:00", "s"),
            ("e", "c", "x", 130, "2024-01-03 14:00", "s"),
        ],
    )
    write_parts(frame, f"{folder}/in", parts=5, size=1)
    changes = ops.stream_changes(stream_of(spark, frame, f"{folder}/in"), RULES)
    with pytest.raises(sinks.LateRows):
        sinks.run_available(changes, f"{folder}/out", f"{folder}/check")
    admitted, late = admission.admit(
        stream_of(spark, frame, f"{folder}/in"), f"{folder}/admission", f"{folder}/check-admission", 6 * 3600
    )
    assert rows(sinks.read_batches(spark, late, frame.schema), "price") == [(90,)]
    on_time = sinks.read_batches(spark, admitted, frame.schema)
    assert rows(on_time, "price") == [(100,), (110,), (120,), (130,)]
    again = ops.stream_changes(stream_of(spark, frame, f"{admitted}/*/*"), RULES)
    assert sinks.run_available(again, f"{folder}/out2", f"{folder}/check2") == 0


def test_late_rows_of_early_batches_count_too(spark, folder):
    """A query remembers its last batches only; the late row is in the fourth of twelve."""
    times = ["01 10:00", "03 10:00", "03 11:00", "01 11:00"] + [f"{k:02d} 10:00" for k in range(4, 12)]
    frame = observations(spark, [("e", "c", "x", 100 + k, f"2024-01-{t}", "s") for k, t in enumerate(times)])
    write_parts(frame, f"{folder}/in", parts=12, size=1)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, 3)
    try:
        changes = ops.stream_changes(stream_of(spark, frame, f"{folder}/in"), RULES, "1 hour")
        with pytest.raises(sinks.LateRows):
            sinks.run_available(changes, f"{folder}/out", f"{folder}/check")
        again = ops.stream_changes(stream_of(spark, frame, f"{folder}/in"), RULES, "1 hour")
        assert sinks.run_available(again, f"{folder}/out2", f"{folder}/check2", allow_late=True) >= 1
    finally:
        spark.conf.unset(kept)


@pytest.mark.parametrize("slice_seconds", [9000, 10**6])
def test_slices_of_any_length_give_the_same_changes(spark, day, folder, slice_seconds):
    admission.replay(day, f"{folder}/in", days=1)
    admission.close(spark, f"{folder}/in", day.schema)
    stream = stream_of(spark, day, f"{folder}/in")
    changes = ops.stream_changes(stream, RULES, "1 day", slice_seconds)
    sinks.run_available(changes, f"{folder}/out", f"{folder}/check")
    got = sinks.read_batches(spark, f"{folder}/out", changes.schema)
    assert rows(got, *COLUMNS) == rows(C.change_events(day, RULES), *COLUMNS)


@pytest.mark.parametrize("gap", [600, None])
def test_changes_with_other_gaps(spark, day, folder, gap):
    """Without a gap the state holds the last price for ever; a gap of nothing pairs equal times."""
    rules = ChangeRules(None, None, None, gap)
    admission.replay(day, f"{folder}/in", days=1)
    admission.close(spark, f"{folder}/in", day.schema)
    changes = ops.stream_changes(stream_of(spark, day, f"{folder}/in"), rules, "1 day")
    sinks.run_available(changes, f"{folder}/out", f"{folder}/check")
    got = sinks.read_batches(spark, f"{folder}/out", changes.schema)
    assert rows(got, *COLUMNS) == rows(C.change_events(day, rules), *COLUMNS)


def test_rows_without_a_time_are_kept_as_late(spark, folder):
    frame = observations(spark, [("e", "c", "x", k, "2024-01-01 10:00", "s") for k in (1, 2)])
    frame = frame.withColumn("observed_at", F.expr("if(price = 2, null, observed_at)"))
    frame.write.parquet(f"{folder}/in")
    for _ in range(2):  # nothing new the second time
        admitted, late = admission.admit(
            stream_of(spark, frame, f"{folder}/in"), f"{folder}/admission", f"{folder}/check", 3600
        )
        assert rows(sinks.read_batches(spark, late, frame.schema), "price") == [(2,)]
        assert rows(sinks.read_batches(spark, admitted, frame.schema), "price") == [(1,)]


def test_a_replayed_backlog_comes_in_order(spark, day, folder):
    assert admission.replay(day.repartition(7), f"{folder}/in", days=1) == 3
    got = changes_of(spark, day, folder, "1 day")
    assert rows(got, *COLUMNS) == rows(C.change_events(day, RULES), *COLUMNS)


def test_state_expires_after_the_gap(spark, folder):
    frame = observations(
        spark,
        [
            ("e", "c", "x", 100, "2024-01-01 10:00", "s"),
            ("e", "c", "y", 100, "2024-01-03 10:00", "s"),
            ("e", "c", "y", 110, "2024-01-03 11:00", "s"),
            ("e", "c", "x", 120, "2024-01-03 12:00", "s"),
        ],
    )
    write_parts(frame, f"{folder}/in", parts=4, size=1)
    assert rows(changes_of(spark, frame, folder), "item", "new_price") == [("y", 110.0)]


def test_alerts(spark, folder):
    frame = spark.createDataFrame([(30.0,), (-25.0,), (24.9,)], "pct_change double")
    assert rows(ops.alerts(frame)) == [(-25.0, "down"), (30.0, "up")]


@pytest.mark.parametrize("how", ["inner", "leftOuter"])
def test_join_of_two_streams(spark, folder, how):
    # a late pair of rows ends the waiting time of everything before it
    seen = observations(
        spark,
        [
            ("e", "c", "x", 1, "2024-01-01 10:05", "s1"),
            ("e", "c", "x", 2, "2024-01-01 12:05", "s2"),
            ("e", "c", "x", 3, "2024-01-01 19:05", "s1"),  # session right, time not
            ("end", "c", "x", 0, "2024-02-01 00:00", "end"),
        ],
    )
    readings = conditions(
        spark,
        [("s1", True, 20.0, "2024-01-01 10:00"), ("end", False, 0.0, "2024-02-01 00:00")],
    )
    write_parts(seen, f"{folder}/seen", parts=2, size=3)
    for end in (False, True):
        part = readings.where((F.col("session_id") == "end") == end)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/readings")
    joined = ops.stream_join(
        stream_of(spark, seen, f"{folder}/seen"),
        stream_of(spark, readings, f"{folder}/readings"),
        how=how,
    )
    sinks.run_available(joined, f"{folder}/out", f"{folder}/check")
    got = sinks.read_batches(spark, f"{folder}/out", joined.schema).where("entity <> 'end'")
    want = [(1.0, True)] + ([(2.0, None), (3.0, None)] if how == "leftOuter" else [])
    assert rows(got, "price", "is_rainy") == want


def test_join_with_a_table(spark, folder):
    seen = observations(spark, [("e", "c", "x", 1, "2024-01-01 10:05", "s1"),
                                ("e", "c", "x", 2, "2024-01-01 12:05", "s2")])
    readings = conditions(spark, [("s1", True, 20.0, "2024-01-01 10:00")])
    seen.write.parquet(f"{folder}/seen")
    joined = ops.stream_join_static(stream_of(spark, seen, f"{folder}/seen"), readings)
    sinks.run_available(joined, f"{folder}/out", f"{folder}/check")
    got = sinks.read_batches(spark, f"{folder}/out", joined.schema)
    assert rows(got, "price", "is_rainy") == [(1.0, True), (2.0, None)]


def test_repeated_captures_are_dropped(spark, folder):
    seen = observations(
        spark,
        [("e", "c", i, 1, "2024-01-01 10:05", s) for i, s in ("as", "as", "bs", "at")],
    )
    write_parts(seen, f"{folder}/in", parts=4, size=1)
    first = ops.stream_dedupe(stream_of(spark, seen, f"{folder}/in"))
    sinks.run_available(first, f"{folder}/out", f"{folder}/check")
    got = sinks.read_batches(spark, f"{folder}/out", first.schema)
    assert rows(got, "item", "session_id", "ordinal") == [("a", "s", 0), ("a", "t", 3), ("b", "s", 2)]


def test_price_files_as_a_stream(spark, folder):
    with open(f"{folder}/prices.csv", "w", encoding="utf-8") as f:
        f.write("restaurant,category,item_name,price,scraped_at,scrape_session_id\n")
        f.write("A,rolls,Roll,₹120,2024-01-01 10:05,20240101_1000\n")
        f.write("A,rolls,Tea,free,2024-01-01 10:05,20240101_1000\n")
    prices = sources.stream_prices_csv(spark, f"{folder}/*.csv")
    sinks.run_available(prices, f"{folder}/out", f"{folder}/check")
    got = sinks.read_batches(spark, f"{folder}/out", prices.schema)
    assert rows(got, "entity", "price") == [("A", 120)]


def test_every_line_of_a_price_file_is_accounted_for(spark, folder):
    lines = ["A,rolls,Roll,₹120,2024-01-01 10:05,s1", "A,rolls,Tea,free,2024-01-01 10:05,s1", "A,rolls",
             "A,rolls,Tea,₹10,soon,s1", "A,rolls,Tea,₹10,2024-01-01 10:05,s1,more"]
    for day in (1, 2):
        with open(f"{folder}/{day}.csv", "w", encoding="utf-8") as f:
            f.write("restaurant,category,item_name,price,scraped_at,scrape_session_id\n" + "\n".join(lines) + "\n")
        for _ in range(2):  # nothing new the second time
            sources.ingest_prices(spark, f"{folder}/*.csv", f"{folder}/out", f"{folder}/check")
        accepted = sources.read_ingested(spark, f"{folder}/out", rejected=False)
        rejected = sources.read_ingested(spark, f"{folder}/out", rejected=True)
        assert rows(accepted, "item", "price") == [("Roll", 120)] * day
        want = [("malformed", "₹10", lines[4]), ("malformed", None, lines[2]), ("price", "free", None), ("time", "₹10", None)]
        assert rows(rejected, "reason", "price_text", "_malformed") == sorted(want * day, key=repr)
    assert "reason" not in accepted.columns and "price_text" not in accepted.columns
    assert sources.read_ingested(spark, f"{folder}/nothing", rejected=True).count() == 0


def test_new_data_with_a_new_checkpoint_is_kept(spark, folder):
    for part, n in (("one", 5), ("two", 7)):
        spark.range(n).write.parquet(f"{folder}/{part}")
        stream = spark.readStream.schema("id long").parquet(f"{folder}/{part}")
        for _ in range(2):  # nothing new the second time
            sinks.run_available(stream, f"{folder}/out", f"{folder}/check-{part}")
    assert sinks.read_batches(spark, f"{folder}/out", spark.range(1).schema).count() == 12


def test_a_repeated_batch_is_written_once(spark, folder):
    spark.range(2).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id long").parquet(f"{folder}/in")
    sinks.run_available(stream, f"{folder}/out", f"{folder}/check")
    before = spark.read.parquet(f"{folder}/out").inputFiles()
    sinks.batch_writer(f"{folder}/out", f"{folder}/check")(spark.range(2), 0)
    assert spark.read.parquet(f"{folder}/out").inputFiles() == before


def test_a_batch_per_slice_however_many_files(spark, day, folder, monkeypatch):
    """A backlog in many parts, or of large slices, is not taken in more batches."""
    monkeypatch.setattr(admission, "FILE_BYTES", 2000)
    slices, files = admission.replay_in_slices(day.repartition(12), f"{folder}/in", days=1)
    assert slices == 3 and files > 1
    stream = sources.stream_table(spark, f"{folder}/in", day.schema, batch_files=files)
    sinks.run_available(stream, f"{folder}/out", f"{folder}/check")
    assert rows(sinks.read_batches(spark, f"{folder}/out", day.schema)) == rows(day)
    batches = spark.read.parquet(f"{folder}/out").select("batch_id", F.to_date("observed_at").alias("d")).distinct()
    assert batches.count() == 3


@pytest.mark.parametrize("gap, buckets", [(6 * 3600, 1), (None, 3)])
def test_keyed_state_of_many_items_in_a_bucket(spark, day, folder, gap, buckets):
    """Items of one bucket are kept apart; null keys and ordinals beyond 2^53 stay whole."""
    rules = ChangeRules(None, None, None, gap)
    day = day.withColumn("ordinal", F.col("ordinal") + 2**60).withColumn(
        "ordinal", F.when(F.col("ordinal") % 50 == 7, None).otherwise(F.col("ordinal"))
    )
    day = day.withColumn("price", F.when(F.col("ordinal") % 31 == 5, None).otherwise(F.col("price")))
    _, files = admission.replay_in_slices(day, f"{folder}/in", days=1)
    admission.close(spark, f"{folder}/in", day.schema)
    stream = sources.stream_table(spark, f"{folder}/in", day.schema, batch_files=files)
    changes = ops.stream_changes_keyed(stream, rules, "1 day", buckets)
    sinks.run_available(changes, f"{folder}/out", f"{folder}/check")
    got = sinks.read_batches(spark, f"{folder}/out", changes.schema)
    assert rows(got, *COLUMNS) == rows(C.change_events(day, rules), *COLUMNS) and len(rows(got)) > 50
