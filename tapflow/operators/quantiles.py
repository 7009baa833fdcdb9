"""Exact quantiles by selection: no task orders more than a bounded number of values."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_path

#: Distinct values of a range that are put in order; a range with more is split first.
SMALL = 1_000_000
# Bits of a double's mantissa, and how they are shared among the digits below the exponent.
MANTISSA = 52
DIGIT_BITS = (17, 17, 18)


def long_values(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """(keys, measure, v): one row per known numeric value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in cols])
    return df.select(*keys, F.inline(pairs)).where(F.col("v").isNotNull() & ~F.isnan("v"))


def digits(v: Column) -> list[Column]:
    """Whole numbers that order, one after the other, as ``v`` does and together tell ``v`` from any other value.

    Sign and exponent come first (some 4,200 values), then the mantissa in parts of 17 and 18 bits: whatever values a
    column holds, a range is split into at most 2 ** 18 and is one value after four digits.
    """
    size = F.abs(v)
    near = F.floor(F.log2(size))
    # The logarithm may be off by one next to a power of two.
    exponent = F.when(F.pow(F.lit(2.0), near) > size, near - 1).when(F.pow(F.lit(2.0), near + 1) <= size, near + 1).otherwise(near)
    mantissa = ((size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(2.0**MANTISSA)).cast("bigint")
    endless = size == F.lit(float("inf"))
    sign = F.when(v < 0, -1).otherwise(1)
    out = [F.when(v == 0, 0).when(endless, sign * 3000).otherwise(sign * (exponent + 1076)).cast("int")]
    left = MANTISSA
    for bits in DIGIT_BITS:
        left -= bits
        part = F.shiftright(mantissa, left).bitwiseAND(F.lit((1 << bits) - 1))
        out.append(F.when((v == 0) | endless, 0).otherwise(sign * part).cast("int"))
    return out


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> tuple[DataFrame, Column]:
    """``right`` with ``cols`` renamed, and the NULL-safe condition that they agree: a NULL key is a group."""
    named = right.withColumnsRenamed({c: f"_{c}" for c in cols})
    return named, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols])


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def hit_ranges(df: DataFrame, cols: list[str], probs: list[float], keys: list[str] = (), small: int = SMALL) -> tuple[DataFrame, DataFrame, list[str]]:
    """(values, asks, range): the values that can hold a wanted rank, which ranks each range is asked for, its columns.

    Values are counted once. As long as a range that is asked for holds more than ``small`` distinct ones, ranges are
    split by the next digit, the split is counted, and only ranges with a wanted rank are read on.
    """
    at = [*keys, "measure"]
    values = long_values(df, cols, list(keys)).groupBy(*at, "v").agg(F.count(F.lit(1)).alias("c"))
    values = _stored(values, "value-counts")
    # Kept small where there are no keys: a row per column, quantile and neighbour.
    hint = (lambda x: x) if keys else F.broadcast
    pos = F.col("prob") * (F.col("n") - 1)
    asks = (
        values.groupBy(*at)
        .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("m"))
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("pos", pos)
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("pos"), F.ceil("pos")))))
        .select(*at, F.lit(0).cast("bigint").alias("before"), "m", "prob", "pos", "rank")
    )
    for level in range(len(DIGIT_BITS) + 1):
        most = asks.agg(F.max("m")).first()[0]
        if most is None or most <= small:
            break
        digit = f"_d{level}"
        values = values.withColumn(digit, digits(F.col("v"))[level])
        split = values.groupBy(*at, digit).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("m"))
        up = Window.partitionBy(*at).orderBy(digit).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        split = split.withColumn("upto", F.sum("n").over(up))
        asked, same = _same(split, asks.drop("m"), at)
        inside = (F.col("rank") >= F.col("before") + F.col("upto") - F.col("n")) & (F.col("rank") < F.col("before") + F.col("upto"))
        found = split.join(hint(asked), same & inside)
        asks = _stored(found.select(*at, digit, (F.col("before") + F.col("upto") - F.col("n")).alias("before"), "m", "prob", "pos", "rank"), "asked-ranges")
        at.append(digit)
        wanted, same = _same(values, asks.select(*at).distinct(), at)
        values = values.join(hint(wanted), same, "left_semi")
        # The last digit leaves a value in each range: nothing to store for another split.
        values = _stored(values, "hit-values")
    return values, asks, at


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], keys: list[str] = (), small: int = SMALL) -> DataFrame:
    """(keys, measure, prob, value), linearly interpolated between ranks.

    Only ranges that hold a wanted rank are put in order (``hit_ranges``), and each of them has at most ``small``
    distinct values, however narrow or skewed a column is.
    """
    group = [*keys, "measure"]
    values, asks, at = hit_ranges(df, cols, probs, keys, small)
    gathered = asks.groupBy(*at).agg(F.first("before").alias("before"), F.collect_list(F.struct("prob", "pos", "rank")).alias("asks"))
    gathered, same = _same(values, gathered, at)
    up = Window.partitionBy(*at).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hint = (lambda x: x) if keys else F.broadcast
    placed = (
        values.withColumn("upto", F.sum("c").over(up))
        .join(hint(gathered), same)
        .withColumn("to", F.col("before") + F.col("upto"))
        .withColumn("ask", F.explode("asks"))
        .where((F.col("ask.rank") >= F.col("to") - F.col("c")) & (F.col("ask.rank") < F.col("to")))
    )
    low, high = F.min("v"), F.max("v")
    share = F.first("ask.pos") - F.floor(F.first("ask.pos"))
    value = F.when(low == high, low).otherwise(low + (high - low) * share)
    return placed.groupBy(*group, F.col("ask.prob").alias("prob")).agg(value.alias("value"))
