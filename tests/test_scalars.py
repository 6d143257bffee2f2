import math

from pyspark.sql import functions as F

from pricetide.config import BandRules
from pricetide.functions import scalars as S
from tests.frames import at


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()["x"]


def column_of(spark, values, kind, make):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in frame.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_half_up_on_ties(spark):
    values = [9.205, 5.205, 2.715, 0.225, 1.005, -1.005, None]
    assert column_of(spark, values, "double", lambda v: S.half_up(v, 2)) == [
        9.21, 5.21, 2.72, 0.23, 1.01, -1.01, None,
    ]


def test_currency(spark):
    texts = ["₹123", " ₹ 45 ", "67", "₹", "12.5", "n/a", None]
    assert column_of(spark, texts, "string", S.currency_to_int) == [
        123, 45, 67, None, None, None, None,
    ]


def test_rain_names(spark):
    names = ["Rain", "DRIZZLE", "thunderstorm", "Squall", "Clouds", "Mist", None]
    assert column_of(spark, names, "string", S.is_rain) == [
        True, True, True, True, False, False, None,
    ]


def test_dish_types(spark):
    items = ["Chicken Biryani", "Momo Combo", "Egg Kathi Roll", "Masala Dosa", "Cold Coffee", None]
    assert column_of(spark, items, "string", S.dish_type) == [
        "Biryani", "Combo", "Roll", "Other", "Beverage", None,
    ]


def test_time_windows(spark):
    hours = [9, 10, 11, 12, 13, 14, 18, 19, 20, 21, 22, 23, None]
    labels = column_of(spark, hours, "int", S.time_window)
    assert [x[0] for x in labels] == list("O112233445") + ["5", "O", "O"]
    assert column_of(spark, [12], "int", lambda h: S.time_window(h, False)) == ["Lunch Peak"]


def test_epoch_micros_does_not_depend_on_the_session_zone(spark):
    frame = spark.createDataFrame([(at("2024-03-31 02:30:01.234567"),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = set()
        for name in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found.add(frame.select(S.epoch_micros("t").alias("x")).head()["x"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == {1711852201234567}


def test_weekend_and_session(spark):
    frame = spark.createDataFrame(
        [(at("2024-01-05 23:59"),), (at("2024-01-06 00:00"),), (at("2024-01-07 10:05"),)],
        "t timestamp_ntz",
    )
    got = frame.select(S.is_weekend(F.col("t")), S.session_id(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        (False, "20240105_2359"), (True, "20240106_0000"), (True, "20240107_1005"),
    ]


def test_minutes(spark):
    frame = spark.createDataFrame([(at("2024-01-05 23:59:58.9"),)], "t timestamp_ntz")
    row = frame.select(
        S.to_minute(F.col("t")).alias("a"), S.parse_minute(F.lit("2024-01-05 23:59")).alias("b")
    ).head()
    assert row["a"] == row["b"] == at("2024-01-05 23:59")


def test_bands(spark):
    frame = spark.createDataFrame([(v,) for v in (24.99, 25.0, 31.99, 32.0, None)], "v double")
    assert [r[0] for r in frame.select(S.temperature_band("v")).collect()] == [
        "Cool", "Normal", "Normal", "Hot", None,
    ]
    wide = BandRules(0.0, 100.0)
    assert frame.select(S.temperature_band("v", wide)).head()[0] == "Normal"


def test_index_band_edges(spark):
    scores = [0.0, 24.99, 25.0, 50.0, 75.0, 75.01]
    open_right = column_of(spark, scores, "double", S.index_band)
    closed = column_of(spark, scores, "double", lambda v: S.index_band(v, True))
    names = ["Static Pricer", "Low Dynamic", "Moderate Dynamic", "Aggressive Dynamic"]
    assert [names.index(x) for x in open_right] == [0, 0, 1, 2, 3, 3]
    assert [names.index(x) for x in closed] == [0, 0, 0, 1, 2, 3]


def test_scales(spark):
    assert column_of(spark, [-5.0, 0.0, 10.0, 20.0, 99.0], "double", lambda v: S.capped_scale(v, 20)) == [
        0.0, 0.0, 50.0, 100.0, 100.0,
    ]
    assert one(spark, S.max_scale(F.lit(3.0), F.lit(0.0))) == 0.0
    assert one(spark, S.minmax_scale(F.lit(3.0), F.lit(3.0), F.lit(3.0))) == 0.0
    assert one(spark, S.zscore_scale(F.lit(3.0), F.lit(3.0), F.lit(0.0))) == 50.0
    assert one(spark, S.zscore_scale(F.lit(9.0), F.lit(3.0), F.lit(1.0))) == 100.0


def test_normal_p(spark):
    values = [0.0, 0.5, 1.0, 1.96, 3.0, 6.0]
    got = column_of(spark, values, "double", S.normal_two_sided_p)
    assert all(abs(p - math.erfc(z / math.sqrt(2))) < 2e-7 for p, z in zip(got, values))


def test_labels(spark):
    assert column_of(spark, [True, False, None], "boolean", S.rain_label) == ["Rain", "Dry", "Dry"]
    assert column_of(spark, [0.7, -0.9, 0.69], "double", S.strength) == [
        "Strong", "Strong", "Moderate",
    ]
    assert column_of(
        spark, [1.0, -1.0, 0.0, None], "double",
        lambda v: S.verdict(F.lit(5), v, 5, "up", "down"),
    ) == ["up", "down", "No significant change", "No significant change"]
    assert one(spark, S.verdict(F.lit(4), F.lit(1.0), 5, "up", "down")) == "No significant change"
