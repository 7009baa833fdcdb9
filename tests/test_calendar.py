from __future__ import annotations

import datetime as dt

import pytest

from tapflow.operators import clean
from tapflow.operators.calendar import business_day_count, business_days_only, months_between
from tests.conftest import at


@pytest.fixture(scope="module")
def off(spark):
    return spark.createDataFrame([(dt.date(2025, 1, 1),), (None,)], "holiday_date date")


def test_business_days(spark, off):
    days = [dt.date(2025, 1, 4), dt.date(2025, 1, 5), dt.date(2025, 1, 1), dt.date(2025, 1, 8), None]
    df = spark.createDataFrame([(d,) for d in days], "op_date date")
    assert [r.op_date for r in business_days_only(df, "op_date", off).collect()] == [dt.date(2025, 1, 8)]


def test_business_day_count(spark, off):
    assert business_day_count(spark, "202501", off).first().business_days == 22
    assert business_day_count(spark, "202502", off).first().business_days == 20


def test_months(spark):
    got = [r.ym for r in months_between(spark, "202411", "202502").collect()]
    assert got == ["202411", "202412", "202501", "202502"]
    for bad in (("202502", "202501"), ("2025", "202501"), ("2025-1", "202501")):
        with pytest.raises(ValueError):
            months_between(spark, *bad)


def test_hour_windows(spark):
    times = ["05:59:59", "06:00:00", "10:59:59", "11:00:00", "15:59:00", "16:00:00", "23:59:00"]
    df = spark.createDataFrame([(at(f"2025-01-06 {t}"),) for t in times], "ts timestamp_ntz")
    kept = lambda lo, hi: [str(r.ts)[11:] for r in clean.in_hours(df, "ts", lo, hi).collect()]
    assert kept(6, 10) == ["06:00:00", "10:59:59"]
    assert kept(16, 24) == ["16:00:00", "23:59:00"]
