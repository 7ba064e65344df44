"""Casts of odd texts against DuckDB's, and of random numbers against exact decimals."""

import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from lakeloom.functions import cleaning

TEXTS = {
    "int": (
        "12", "-7", "+5", " 7 ", "12.5", "-12.5", "0.5", "-0.5", ".5", "5.", "1e3", "1E3", "1e-3", "abc", "",
        "2147483647", "2147483648", "-2147483648", "99999999999", "1 000", "1,000", "--5", "1.2.3", "true", "1e10",
        "1e2.5", "12abc", "0012", "-0", "1e", "e5", "+", "1.49999999999999", "1_000", "1_0_0", "_1", "1_", "1__0",
        "0x1A", "0xff", "0x", "0xg", "1_000.5",
    ),
    "bigint": ("9223372036854775807", "9223372036854775808", "-9223372036854775808", "1e18", "1e19", "123.0"),
    "smallint": ("32767", "32768", "-32768", "99.5", "32767.5"),
    "double": (
        "1.5", "-34.6", "1e308", "inf", "-inf", "Infinity", "abc", "", " 1.5 ", "1,5", ".5", "5.", "+1", "1d", "1f",
        "1.5D", "f", "d", "1_000.5", "1_000", "0x1p3", "0x1A", "nan", "NaN", "+inf", "infinit", "1e", "1.5.2", '{"a": 1}',
    ),
    "timestamp_ntz": (
        "2024-01-02 03:04:05", "2024-01-02T03:04:05", "2024-01-02", "2024-1-2 3:4:5", "2024-01-02 03:04",
        "2024-01-02 03:04:05.123456", "2024-01-02 03:04:05.1234567", "2024-02-30 00:00:00", "01/02/2024", "", "x",
        "2024-01-02 03", "2024", "2024-01", "  2024-01-02 03:04:05  ", "20240102", "now",
    ),
    "date": (
        "2024-01-02", "2024-1-2", "2024-02-30", "2024/01/02", "01/02/2024", "2024-01-02 03:04:05", "", "x", "2024",
        "2024-01", " 2024-01-02 ", "20240102",
    ),
}


def cast(spark, texts, to):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    return [r.x for r in df.select("i", cleaning.tolerant(to)(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("to", list(TEXTS))
def test_odd_texts(spark, to):
    target = {"int": "integer", "timestamp_ntz": "timestamp"}.get(to, to)
    want = [duckdb.execute(f"select try_cast(? as {target})", [text]).fetchall()[0][0] for text in TEXTS[to]]
    got = cast(spark, TEXTS[to], to)
    assert dict(zip(TEXTS[to], map(str, got))) == dict(zip(TEXTS[to], map(str, want)))


def test_random_numbers(spark):
    rng = random.Random(3)
    texts, want = [], []
    for _ in range(3000):
        number = Decimal(rng.randrange(-(10**12), 10**12)).scaleb(-rng.randrange(0, 9))
        whole = int(number.quantize(Decimal(1), ROUND_HALF_UP))
        texts.append(f"{number:,f}" if rng.random() < 0.5 else f"{number:f}")
        want.append(whole if -(2**31) <= whole < 2**31 else None)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = df.select("i", cleaning.grouped_int()(F.col("v")).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == want
