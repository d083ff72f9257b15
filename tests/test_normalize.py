"""Normalisation expressions: the source system's unit cases and the appendix edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from innflow.functions import normalize as N


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn("v")).collect()]


_BATCH: dict = {}


def _batched(spark, key, cases, fn):
    """Evaluate every case of one table in a single Spark job; look results up per case."""
    if key not in _BATCH:
        values = [c[0] for c in cases]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        out = {r[0]: r[1] for r in df.select("i", fn("v")).collect()}
        _BATCH[key] = {values[i]: out[i] for i in out}
    return _BATCH[key]


STATUS_CASES = [
    ("Confirmed", "confirmed"), ("CNF", "confirmed"), ("cancelled", "cancelled"), ("CANCELED", "cancelled"),
    ("checked-in", "checked_in"), ("garbage_value", "unknown"), (None, "unknown"), ("", "unknown"),
]


@pytest.mark.parametrize("raw,expected", STATUS_CASES)
def test_booking_status(spark, raw, expected):
    assert _batched(spark, "status", STATUS_CASES, N.booking_status)[raw] == expected


def test_status_strip_and_case(spark):
    got = _one(spark, ["  No Show ", "\tCHECKED OUT", "ns", "Success", "DECLINED", "chargeback"], lambda c: F.array(
        N.booking_status(c), N.payment_status(c)))
    assert [g[0] for g in got[:3]] == ["no_show", "checked_out", "no_show"]
    assert [g[1] for g in got[3:]] == ["paid", "failed", "unknown"]


FORMAT_CASES = [(v,) for v in ["2025-01-15", "15/01/2025", "01-15-2025", "15-Jan-2025", "2025/01/15"]]


@pytest.mark.parametrize("raw", [c[0] for c in FORMAT_CASES])
def test_date_formats(spark, raw):
    assert _batched(spark, "formats", FORMAT_CASES, N.parse_date)[raw] == dt.datetime(2025, 1, 15)


def test_blank_date(spark):
    assert _one(spark, ["", None, "   "], N.parse_date) == [None, None, None]


DATE_CASES = [
    ("05/06/2025", dt.datetime(2025, 6, 5)),      # day first in a date column
    ("01/25/2025", dt.datetime(2025, 1, 25)),     # day-first fails, month-first fallback
    ("05-06-2025", dt.datetime(2025, 5, 6)),      # month-day format
    ("25-12-2025", dt.datetime(2025, 12, 25)),    # month-day fails, day-month fallback
    ("15-JAN-2025", dt.datetime(2025, 1, 15)),    # any case month name
    ("2025-1-5", dt.datetime(2025, 1, 5)),
    ("2025/1/5", dt.datetime(2025, 1, 5)),
    ("15-January-2025", dt.datetime(2025, 1, 15)),
    ("20250115", dt.datetime(2025, 1, 15)),
    ("March 5, 2025", dt.datetime(2025, 3, 5)),
    ("2025-01-15 10:00", dt.datetime(2025, 1, 15, 10, 0)),
    ("2025-01-15T10:00:00", dt.datetime(2025, 1, 15, 10, 0)),
    ("2025-02-30", None), ("31/02/2025", None), ("garbage", None), ("12", None), ("15/01/25", None),
    ("2300-01-01", dt.datetime(2300, 1, 1)),
    ("15 Jan 2025", dt.datetime(2025, 1, 15)), ("Jan 15, 2025", dt.datetime(2025, 1, 15)), ("15.01.2025", dt.datetime(2025, 1, 15)),
    ("2025.01.15", dt.datetime(2025, 1, 15)), ("2025-01-15T10:00", dt.datetime(2025, 1, 15, 10, 0)), ("15-Foo-2025", None),
    ("@2025-01-15 |x|", None), ("2025", None), ("may 5, 2025", dt.datetime(2025, 5, 5)), ("2025-01-15 25:00", None),
]


@pytest.mark.parametrize("raw,expected", DATE_CASES)
def test_date_edge_cases(spark, raw, expected):
    assert _batched(spark, "dates", DATE_CASES, N.parse_date)[raw] == expected


TS_CASES = [
    ("2025-05-20 10:00:00", dt.datetime(2025, 5, 20, 10, 0)),
    ("20/05/2025 10:00", dt.datetime(2025, 5, 20, 10, 0)),
    ("05-20-2025 01:30 PM", dt.datetime(2025, 5, 20, 13, 30)),
    ("2025-05-20", dt.datetime(2025, 5, 20)),
    ("05/06/2025", dt.datetime(2025, 5, 6)),      # month first in a timestamp column
    ("15/01/2025 09:30:15", dt.datetime(2025, 1, 15, 9, 30, 15)),
    ("15-Jan-2025", dt.datetime(2025, 1, 15)),
    ("01-15-2025 13:30 PM", None), ("01-15-2025 12:05 AM", dt.datetime(2025, 1, 15, 0, 5)),
    ("2025-01-15 10:00:00.123", dt.datetime(2025, 1, 15, 10, 0, 0, 123000)),
    ("2025-01-15 10:00:00.123456", dt.datetime(2025, 1, 15, 10, 0, 0, 123456)),
    ("2025-01-15 10:00:00.123456789", dt.datetime(2025, 1, 15, 10, 0, 0, 123456)),
    ("2025-01-15T10:00:00.123Z", dt.datetime(2025, 1, 15, 10, 0, 0, 123000)),
    ("2025-01-15T10:00:00+0200", dt.datetime(2025, 1, 15, 8, 0)), ("2025-01-15 10:00:00-05:30", dt.datetime(2025, 1, 15, 15, 30)),
    ("2025/01/15 10:00:00", dt.datetime(2025, 1, 15, 10, 0)), ("15-Jan-2025 10:00:00", dt.datetime(2025, 1, 15, 10, 0)),
    ("01/15/2025 11:30 PM", dt.datetime(2025, 1, 15, 23, 30)), ("15 January 2025 10:00", dt.datetime(2025, 1, 15, 10, 0)),
    ("n/a", None),
]


@pytest.mark.parametrize("raw,expected", TS_CASES)
def test_timestamp_edge_cases(spark, raw, expected):
    assert _batched(spark, "ts", TS_CASES, N.parse_timestamp)[raw] == expected


LONG_CASES = [
    ("1", 1), (" 7 ", 7), ("\t7 ", 7), ("1.0", 1), ("1e3", 1000), ("007", 7), ("+5", 5),
    ("1.5", None), ("inf", None), ("1,000", None), ("0x10", None), ("abc", None), ("", None), (None, None),
    ("123456789012345678901", None), ("-3", -3), ("9007199254740993.0", 9007199254740993), ("1e30", None), ("-2.50e1", -25),
]


@pytest.mark.parametrize("raw,expected", LONG_CASES)
def test_to_long(spark, raw, expected):
    assert _batched(spark, "long", LONG_CASES, N.to_long)[raw] == expected


AMOUNT_CASES = [
    ("150.00", True, False, Decimal("150.00")),
    ("-50.00", True, True, Decimal("-50.00")),
    ("-0.001", True, True, Decimal("0.00")),      # negative before rounding: caught by the sign rule
    ("12.345", True, False, Decimal("12.35")),    # half-up from the decimal text
    ("inf", False, None, None),
    ("NaN", False, None, None),
    ("123456789.1", True, False, None),           # does not fit decimal(10,2): contract rule
    ("1d", False, None, None),
    (" 12 ", True, False, Decimal("12.00")),
]


@pytest.mark.parametrize("raw,number,negative,amount", AMOUNT_CASES)
def test_amounts(spark, raw, number, negative, amount):
    got = _batched(spark, "amount", AMOUNT_CASES,
                   lambda c: F.struct(N.to_double(c).isNotNull(), N.to_double(c) < 0, N.to_decimal(c)))
    assert tuple(got[raw]) == (number, negative, amount)


def test_clean_str(spark):
    assert _one(spark, ["  Ada  ", "nan", "", "　x ", None, " nan "], N.clean_str) == [
        "Ada", None, None, "x", None, None]


def test_header_normalisation():
    assert N.normalize_header([" Guest_ID", "First_Name "]) == ["guest_id", "first_name"]
    with pytest.raises(ValueError):
        N.normalize_header(["a", " A"])


def test_parsing_ignores_session_time_zone(spark):
    """Wall-clock text inside a daylight-saving gap or overlap keeps its value in any session zone."""
    s2 = spark.newSession()
    s2.conf.set("spark.sql.session.timeZone", "America/New_York")
    df = s2.createDataFrame([("2025-03-09 02:30:00",), ("2025-11-02 01:30:00",), ("2025-01-15T10:00:00+02:00",)],
                            "v string")
    got = [r[0] for r in df.select(N.parse_timestamp("v")).collect()]
    assert got == [dt.datetime(2025, 3, 9, 2, 30), dt.datetime(2025, 11, 2, 1, 30), dt.datetime(2025, 1, 15, 8, 0)]


def test_long_is_decided_by_digits(spark):
    cases = {".99999999999999999999": None, "6.9999999999999999999": None, "7.0000000000000000001": None, "7.00000000000000000000000": 7, "70e-1": 7,
             "-70.0E-1": -7, "7e18": 7 * 10 ** 18, "7e19": None, "1e-1": None, "0e999999999999": 0, "1e999999999999": None, "1e-999999999999": None,
             "0.0e5": 0, ".5e1": 5, "00.70e1": 7, "9007199254740993.0": 9007199254740993, "9223372036854775807.0": 2 ** 63 - 1,
             "9223372036854775808.0": None, "-9223372036854775808.": -(2 ** 63), "000000000000000000000000000001e2": 100, "5.": 5, "+.0": 0}
    df = spark.createDataFrame([(t,) for t in cases], "v string")
    got = {r.v: r.n for r in df.select("v", N.to_long("v").alias("n")).collect()}
    assert got == cases
