import datetime as dt

import pytest
from pyspark.sql import functions as F

from chainmart import functions as fn


def evaluate(spark, values, expr, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_hex_to_long(spark):
    cases = {
        "0x1F": 31,
        " 0Xff ": 255,
        "42": 42,
        "-7": -7,
        "+7": 7,
        "0x": None,
        "zz": None,
        "0xzz": None,
        "": None,
        None: None,
        "0x7fffffffffffffff": 2**63 - 1,
        "0x8000000000000000": None,
        "0x" + "0" * 40 + "a": 10,
        "0xf0000000000000000": None,
        "99999999999999999999": None,
        "1f": None,
        "0x0": 0,
    }
    assert evaluate(spark, list(cases), fn.hex_to_long) == list(cases.values())


def test_base16_to_long(spark):
    cases = {"10": 16, "0x10": 16, "ff": 255, "zz": None, None: None, "": None}
    assert evaluate(spark, list(cases), fn.base16_to_long) == list(cases.values())


def test_split_symbol(spark):
    cases = {
        "ETHUSDT": ("ETH", "USDT"),
        " ethbusd ": ("ETH", "BUSD"),
        "BUSD": ("B", "USD"),
        "ETH": (None, None),
        "USDT": (None, None),
        "ETHBTC": ("ETH", "BTC"),
        "FOO": (None, None),
        "": (None, None),
        None: (None, None),
    }
    got = [tuple(r) for r in evaluate(spark, list(cases), fn.split_symbol)]
    assert got == list(cases.values())


def test_interval_seconds(spark):
    cases = {
        "1m": 60,
        "1M": 60,
        "15m": 900,
        "4h": 14400,
        "1d": 86400,
        "1w": 604800,
        "30s": 30,
        " 5m ": 300,
        "m": None,
        "1y": None,
        "x5m": None,
        None: None,
        "99999999999999999999h": None,
        "-1m": -60,
    }
    assert evaluate(spark, list(cases), fn.interval_seconds) == list(cases.values())


def test_iso_date_agrees_with_python(spark):
    texts = [
        "2026-01-01",
        "20260101",
        "2026-1-1",
        "junk",
        "2026-02-30",
        "2024-W01-5",
        "2024W015",
        "2024-W01",
        "2024W53",
        "2020-W53-7",
        "2021-W53-1",
        "2024-W015",
        "2024W01-5",
        "2024-W00-1",
        "2024-W10-8",
        " 2026-01-01",
        "0001-01-01",
    ]

    def python(text):
        try:
            return dt.date.fromisoformat(text)
        except ValueError:
            return None

    assert evaluate(spark, texts, fn.iso_date) == [python(t) for t in texts]


def test_iso_timestamp(spark):
    cases = {
        "2026-01-01T00:01:05Z": dt.datetime(2026, 1, 1, 0, 1, 5),
        "2026-01-01T02:01:05+02:00": dt.datetime(2026, 1, 1, 0, 1, 5),
        "2026-01-01T00:01:05": dt.datetime(2026, 1, 1, 0, 1, 5),
        "12:30": None,
        "junk": None,
        None: None,
    }
    got = evaluate(spark, list(cases), lambda c: fn.iso_timestamp(c).cast("timestamp_ntz"))
    assert got == list(cases.values())


@pytest.mark.parametrize(
    "n, expected", [(10, "10:30"), (7, "10:35"), (60, "10:00"), (90, "10:00"), (1, "10:37"), (25, "10:25")]
)
def test_minute_bucket_is_aligned_to_the_hour(spark, n, expected):
    got = evaluate(spark, [dt.datetime(2024, 1, 1, 10, 37, 59)], lambda c: fn.minute_bucket(c, n), "timestamp_ntz")
    assert got[0].strftime("%H:%M:%S") == expected + ":00"


def test_minute_ceiling(spark):
    values = [dt.datetime(2024, 1, 1, 10, 37), dt.datetime(2024, 1, 1, 10, 37, 0, 1), dt.datetime(2024, 1, 1, 23, 59, 30)]
    got = evaluate(spark, values, fn.minute_ceiling, "timestamp_ntz")
    assert got == [values[0], dt.datetime(2024, 1, 1, 10, 38), dt.datetime(2024, 1, 2)]


def test_calendar_fields(spark):
    sunday = dt.datetime(2023, 1, 1, 13, 5)  # ISO week 52 of the year before
    df = spark.createDataFrame([(sunday,)], "ts timestamp_ntz")
    row = df.select(*fn.calendar_fields(F.col("ts"))).first()
    assert row.asDict() == {
        "date": sunday.date(),
        "year": 2023,
        "quarter": 1,
        "month": 1,
        "day": 1,
        "hour": 13,
        "minute": 5,
        "day_of_week": 0,
        "week_of_year": 52,
        "is_weekend": True,
    }


def test_corr_band_boundaries(spark):
    values = [0.7, 0.999, 1.0, 0.3, 0.299, -0.3, -0.31, -0.7, -0.71, -1.0, -1.5, None, float("nan")]
    got = evaluate(spark, values, fn.corr_band, "double")
    assert got == [
        "strong positive",
        "strong positive",
        "weak",  # exactly 1.0 is in no band
        "moderate positive",
        "weak",
        "weak",
        "moderate negative",
        "moderate negative",
        "strong negative",
        "strong negative",
        "weak",
        "N/A",
        "N/A",
    ]


def test_epochs_and_text(spark):
    ms = evaluate(spark, ["1767225600123", "junk", None], lambda c: fn.from_epoch_ms(c).cast("timestamp_ntz"))
    assert ms == [dt.datetime(2026, 1, 1, 0, 0, 0, 123000), None, None]
    s = evaluate(spark, ["1767225600", "x"], lambda c: fn.from_epoch_s(c).cast("timestamp_ntz"))
    assert s == [dt.datetime(2026, 1, 1), None]
    assert evaluate(spark, [" eth ", "  ", None], fn.clean_symbol) == ["ETH", None, None]
    assert evaluate(spark, ["/ETH--USDT!"], lambda c: fn.cursor_key(c, F.lit("1m"))) == ["ETH_USDT__1m"]


def test_decimals_round_half_up_and_never_fail(spark):
    got = evaluate(spark, ["0.125", "2.675", "1e30", "NaN", "abc"], lambda c: fn.as_decimal(c, 10, 2).cast("string"))
    assert got == ["0.13", "2.68", None, None, None]


def test_pearson_edge_cases(spark):
    def corr(rows):
        return spark.createDataFrame(rows, "x double, y double").agg(fn.pearson(F.col("x"), F.col("y"))).first()[0]

    assert corr([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]) == pytest.approx(1.0)
    assert corr([(1.0, 2.0), (1.0, 4.0)]) is None  # constant side
    assert corr([(1.0, 2.0)]) is None
    assert corr([(None, 2.0), (1.0, None)]) is None
    # pairs only: the lone values must not shift the means
    assert corr([(1.0, 2.0), (2.0, 1.0), (100.0, None), (None, 50.0)]) == pytest.approx(-1.0)


def test_hours_between(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 1, 30))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(fn.hours_between(F.col("a"), F.col("b"))).first()[0] == 25.5
