import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import cleaning, derive


def apply(spark, step, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", step(F.col("v")).alias("x")).orderBy("i").collect()]


def test_grouped_int(spark):
    values = ["1,020", "1,234,567", "90", "x", "", None, " 7 ", "12.5", "13.5", "-12.5", "1e3", "99999999999"]
    assert apply(spark, cleaning.grouped_int(), values) == [
        1020, 1234567, 90, None, None, None, 7, 13, 14, -13, 1000, None,
    ]


def test_strip_and_strict(spark):
    strip = cleaning.strip_text("TOK")
    assert apply(spark, lambda c: cleaning.strict("bigint")(strip(c)), ["12TOK", "7", None]) == [12, 7, None]
    artifact = cleaning.strip_text(".0")
    assert apply(spark, lambda c: cleaning.strict("bigint")(artifact(c)), ["123.0", "45"]) == [123, 45]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "to, bad", [("bigint", "abc"), ("smallint", "40000"), ("timestamp_ntz", "yesterday"), ("date", "2024-13-01")]
)
def test_strict_fails_whatever_the_session(spark, ansi, to, bad):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="cannot read as"):
            apply(spark, cleaning.strict(to), [bad])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_tolerant(spark):
    assert apply(spark, cleaning.tolerant("double"), ["1.5", "x", None]) == [1.5, None, None]
    assert apply(spark, cleaning.tolerant("timestamp_ntz"), ["2024-01-02 03:04:05", "", "n/a"]) == [
        dt.datetime(2024, 1, 2, 3, 4, 5), None, None,
    ]


def test_null_outside(spark):
    assert apply(spark, cleaning.null_outside(16, 100), [15, 16, 100, 101, None], "int") == [
        None, 16, 100, None, None,
    ]


def test_map_values(spark):
    step = cleaning.map_values({"Yes": True, "No": False}, "boolean")
    assert apply(spark, step, ["Yes", "No", "yes", None]) == [True, False, None, None]


def test_time_of_day_as_text(spark):
    assert apply(spark, cleaning.time_of_day(False), ["12:34:56", "1:02:03", None]) == ["12:34:56", "01:02:03", None]
    with pytest.raises(Exception, match="cannot read as time"):
        apply(spark, cleaning.time_of_day(False), ["25:00:00"])


def test_time_of_day_native(spark):
    assert apply(spark, cleaning.time_of_day(True), ["12:34:56", None]) == [dt.time(12, 34, 56), None]


def test_band_edges(spark):
    def step(c):
        return derive.band(c, (16, 26, 36, 51, 66), ("16-25", "26-35", "36-50", "51-65", "66+"), "none")

    ages = [None, 15, 16, 25, 26, 35, 36, 50, 51, 65, 66, 100]
    assert apply(spark, step, ages, "int") == [
        "none", "none", "16-25", "16-25", "26-35", "26-35", "36-50", "36-50", "51-65", "51-65", "66+", "66+",
    ]


def test_band_wants_ascending_edges():
    with pytest.raises(ValueError):
        derive.band(None, (5, 1), ("a", "b"), "c")


def test_date_key_and_weekday(spark):
    days = [dt.date(2022, 1, 1), dt.date(2024, 12, 31), dt.date(2024, 3, 3), None]
    assert apply(spark, derive.date_key, days, "date") == [20220101, 20241231, 20240303, None]
    assert apply(spark, derive.iso_weekday, days, "date") == [6, 2, 7, None]


def test_whole_mean(spark):
    df = spark.createDataFrame([(0, 90, 1), (1, 150, 1), (2, 119, 1), (3, 0, 0)], "i int, t bigint, n bigint")
    even = df.orderBy("i").select(derive.whole_mean(F.col("t"), F.col("n"), 60).alias("x"))
    cut = df.orderBy("i").select(derive.whole_mean(F.col("t"), F.col("n"), 60, "trunc").alias("x"))
    assert [r.x for r in even.collect()] == [2, 2, 2, None]
    assert [r.x for r in cut.collect()] == [1, 2, 1, None]
    with pytest.raises(ValueError):
        derive.whole_mean(F.col("t"), F.col("n"), 60, "up")


def central_angle(*degrees):
    """Angle between two points from their vectors on the unit sphere."""
    lat_a, lon_a, lat_b, lon_b = map(math.radians, degrees)
    a = (math.cos(lat_a) * math.cos(lon_a), math.cos(lat_a) * math.sin(lon_a), math.sin(lat_a))
    b = (math.cos(lat_b) * math.cos(lon_b), math.cos(lat_b) * math.sin(lon_b), math.sin(lat_b))
    return 2 * math.asin(math.dist(a, b) / 2)


def test_haversine(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0), (None, 0.0, 1.0, 1.0),
         (-34.6, -58.4, -34.5, -58.3)],
        "a double, b double, c double, d double",
    )
    got = [r.x for r in df.select(derive.haversine_km(*[F.col(c) for c in "abcd"]).alias("x")).collect()]
    half = 6371 * 3.141592653589793
    assert got[0] == 0 and got[1] == pytest.approx(half) and got[2] == pytest.approx(half)
    assert got[3] is None and got[4] == pytest.approx(central_angle(-34.6, -58.4, -34.5, -58.3) * 6371, abs=1e-6)
