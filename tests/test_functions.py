import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hiremart.functions import (currency_label, day_of_week_sun0, naive_timestamp,
                                parse_iso_timestamp, round_half_up, safe_ratio, salary_point,
                                text_to_bool, text_to_decimal)


def test_salary_point_cases(spark):
    df = spark.createDataFrame(
        [(Decimal("100.00"), Decimal("201.01")), (Decimal("100.00"), None),
         (None, Decimal("50.50")), (None, None)], "lo decimal(18,2), hi decimal(18,2)")
    got = [r[0] for r in df.select(salary_point("lo", "hi")).collect()]
    assert got == [Decimal("150.505"), Decimal("100.000"), Decimal("50.500"), None]


def test_currency_label(spark):
    df = spark.createDataFrame([("RUR",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(currency_label("c")).collect()] == ["RUR", "UNKNOWN", "UNKNOWN"]


def test_naive_timestamp_drops_offset(spark):
    df = spark.createDataFrame([("2025-11-11T19:03:31+0300",), ("2025-11-11T19:03:31Z",),
                                ("2025-11-11T19:03:31-0500",), (None,)], "s string")
    got = [r[0] for r in df.select(naive_timestamp("s")).collect()]
    assert got[:3] == [dt.datetime(2025, 11, 11, 19, 3, 31)] * 3 and got[3] is None


def test_parse_iso_timestamp_applies_offset(spark):
    df = spark.createDataFrame([("2025-11-11T19:03:31+0300",), ("2025-11-11T19:03:31Z",)], "s string")
    got = [r[0] for r in df.select(parse_iso_timestamp("s").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2025, 11, 11, 16, 3, 31), dt.datetime(2025, 11, 11, 19, 3, 31)]


def test_text_casts_and_ratio(spark):
    df = spark.createDataFrame([("true", "12.50", 1, 4), ("", "", 1, 0)], "b string, d string, a int, z int")
    r = df.select(text_to_bool("b"), text_to_decimal("d"), safe_ratio("a", "z")).collect()
    assert r[0][0] is True and r[0][1] == Decimal("12.50") and r[0][2] == 0.25
    assert r[1][0] is None and r[1][1] is None and r[1][2] is None


def test_day_of_week_sunday_zero(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2021, 1, 9),)], "d date")
    assert [r[0] for r in df.select(day_of_week_sun0("d")).collect()] == [0, 6]


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.0000005,), (1.25,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 6)).collect()] == [0.000001, 1.25]
