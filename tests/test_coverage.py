import datetime as dt
import random

import pytest

from pricetide.config import SkewRules, SlotRules
from pricetide.operators import coverage
from tests.frames import at, observations, rows


def test_missing_slots(spark):
    seen = observations(
        spark,
        [
            ("a", "c", "x", 1, "2024-01-01 10:05", "s"),
            ("a", "c", "x", 1, "2024-01-01 11:10", "s"),  # nearer to 12:00
            ("a", "c", "x", 1, "2024-01-01 23:30", "s"),  # too far from 22:00
            ("b", "c", "x", 1, "2024-01-02 13:00", "s"),  # between two slots: the earlier
        ],
    )
    missing = rows(coverage.slot_coverage(seen))
    day1, day2 = at("2024-01-01").date(), at("2024-01-02").date()
    slots = SlotRules().slot_minutes
    want = [("a", day1, s) for s in slots if s not in (600, 720)]
    want += [("a", day2, s) for s in slots]
    want += [("b", day1, s) for s in slots]
    want += [("b", day2, s) for s in slots if s != 720]
    assert missing == sorted(want, key=repr)


def test_next_slot(spark):
    frame = spark.createDataFrame(
        [(at(t),) for t in ("2024-01-01 09:59", "2024-01-01 10:00", "2024-01-01 21:30",
                            "2024-01-01 22:10")],
        "t timestamp_ntz",
    )
    got = coverage.next_slot(frame, "t").orderBy("t").collect()
    assert [tuple(r)[1:] for r in got] == [(600, 1, 7), (720, 120, 6), (1320, 30, 1), (None, None, 0)]


def greedy(runs, gap):
    """Skip a run whose elapsed time since the last kept end, in whole minutes, is short."""
    kept, end = [], None
    for s, e in sorted(runs):
        if end is None or (s - end).total_seconds() // 60 >= gap:
            kept.append((s, e))
            end = e
    return kept


def thinned(spark, runs, **rules):
    frame = spark.createDataFrame(
        [(e, s, t) for e, data in runs.items() for s, t in data],
        "entity string, started_at timestamp_ntz, ended_at timestamp_ntz",
    )
    got = coverage.min_gap_thinning(frame, **rules).collect()
    return {e: sorted((r["started_at"], r["ended_at"]) for r in got if r["entity"] == e) for e in runs}


def test_thinning_against_brute_force(spark):
    chance = random.Random(7)
    runs = {e: [] for e in ("hot", "b", "c")}
    base = at("2024-01-01 00:00")
    for _ in range(500):
        e = chance.choice(["hot"] * 8 + ["b", "c"])
        start = base + dt.timedelta(seconds=chance.randrange(0, 4000 * 60))
        runs[e].append((start, start + dt.timedelta(seconds=chance.randrange(0, 90 * 60))))
    assert thinned(spark, runs) == {e: greedy(data, 60) for e, data in runs.items()}


@pytest.mark.parametrize("gap, hot", [(60, 100), (5, 50), (600, 100)])
def test_thinning_of_a_cut_entity(spark, gap, hot):
    """Islands and slices do not show in the result; long runs reach over many slices."""
    chance = random.Random(gap)
    base = at("2024-01-01 00:00")
    runs = {"hot": [], "b": []}
    for k in range(400):
        start = base + dt.timedelta(minutes=chance.randrange(0, 20_000))
        length = 3000 if k % 100 == 0 else chance.randrange(0, 40)
        runs["hot" if k % 8 else "b"].append((start, start + dt.timedelta(minutes=length)))
    got = thinned(spark, runs, rules=SlotRules(min_gap_minutes=gap), skew_rules=SkewRules(hot, 20))
    assert got == {e: greedy(data, gap) for e, data in runs.items()}


def test_thinning_counts_seconds_and_keeps_runs_of_one_minute_apart(spark):
    base = at("2024-01-01 10:00")

    def run(start, end):
        return base + dt.timedelta(seconds=start), base + dt.timedelta(seconds=end)

    close = [run(-600, 55), run(65 + 59 * 60, 65 + 60 * 60)]  # 59 min 10 s later
    together = [run(0, 300), run(30, 3 * 3600), run(5400, 5500)]
    got = thinned(spark, {"a": close, "b": together})
    assert got == {"a": close[:1], "b": [together[0], together[2]]}


def log(spark):
    return spark.createDataFrame(
        [("a", "success", f"s{n}", f"2024-01-01 {n:02d}:00:00", n) for n in range(8)]
        + [("b", "failed", "s1", "2024-01-01 01:00:00", None)],
        "entity string, status string, session_id string, time string, duration_minutes int",
    )


def test_recent_runs(spark):
    got = coverage.recent_runs(log(spark), 5).orderBy("entity", "position").collect()
    assert [(r["entity"], r["session_id"]) for r in got] == [
        ("a", "s7"), ("a", "s6"), ("a", "s5"), ("a", "s4"), ("a", "s3"), ("b", "s1"),
    ]


def test_status(spark):
    assert rows(coverage.run_status(log(spark))) == [
        ("a", "success", "s7", "2024-01-01 07:00:00", 7, 8, 8),
        ("b", "failed", "s1", "2024-01-01 01:00:00", None, 1, 0),
    ]
