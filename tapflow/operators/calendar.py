"""Months, weekdays, holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import is_weekday, year_month


def months_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``ym`` for every month from ``start`` to ``end`` (``YYYYMM``), inclusive."""
    if len(start) != 6 or len(end) != 6 or not (start + end).isdigit():
        raise ValueError("months are written YYYYMM")
    if end < start:
        raise ValueError("the last month lies before the first")
    bounds = spark.range(1).select(
        F.to_date(F.lit(start + "01"), "yyyyMMdd").alias("first"),
        F.to_date(F.lit(end + "01"), "yyyyMMdd").alias("last"),
    )
    return month_span(bounds, F.col("first"), F.col("last"))


def month_span(df: DataFrame, first: Column, last: Column) -> DataFrame:
    steps = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH"))
    return df.select(F.explode(steps).alias("month_start")).select(
        year_month(F.col("month_start")).alias("ym")
    )


def business_days_only(df: DataFrame, date_col: str, holidays: DataFrame) -> DataFrame:
    """Monday to Friday, holidays excluded. A NULL date is dropped."""
    listed = holidays.select(F.col("holiday_date").alias("_holiday")).where(F.col("_holiday").isNotNull()).distinct()
    return df.where(is_weekday(F.col(date_col))).join(
        listed, F.col(date_col) == F.col("_holiday"), "left_anti"
    )


def business_day_counts(months: DataFrame, holidays: DataFrame) -> DataFrame:
    """Business days of each ``ym``; a month without any still gets its row."""
    first = F.to_date(F.concat(F.col("ym"), F.lit("01")), "yyyyMMdd")
    days = months.select("ym").distinct().select("ym", F.explode(F.sequence(first, F.last_day(first))).alias("day"))
    listed = holidays.select(F.col("holiday_date").alias("day")).distinct().withColumn("_off", F.lit(True))
    return (
        days.join(listed, "day", "left")
        .groupBy("ym")
        .agg(F.count(F.when(is_weekday(F.col("day")) & F.col("_off").isNull(), 1)).alias("business_days"))
    )


def business_day_count(spark: SparkSession, ym: str, holidays: DataFrame) -> DataFrame:
    return business_day_counts(months_between(spark, ym, ym), holidays)
