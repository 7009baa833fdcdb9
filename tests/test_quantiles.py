from __future__ import annotations

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from tapflow.operators.quantiles import exact_quantiles, hit_ranges
from tapflow.operators.quality import describe_numeric


@pytest.mark.parametrize("kind", ["wide", "ties", "negative", "tiny"])
def test_equals_linear_interpolation(spark, kind):
    rnd = random.Random(kind)
    make = {
        "wide": lambda: rnd.expovariate(1e-4),
        # One value fills a third of the rows.
        "ties": lambda: 5.0 if rnd.random() < 0.34 else float(rnd.randint(0, 9)),
        "negative": lambda: rnd.gauss(0, 1e6),
        "tiny": lambda: rnd.uniform(-1e-6, 1e-6),
    }[kind]
    values = [make() for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    probs = [0.0, 0.25, 0.5, 0.77, 0.97, 1.0]
    got = {r.prob: r.value for r in exact_quantiles(df, ["v"], probs).collect()}
    assert got == {p: pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-18) for p in probs}


def test_groups_and_several_columns(spark):
    rnd = random.Random(1)
    rows = [(g, rnd.random(), rnd.randint(0, 50)) for g in "abc" for _ in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "g string, x double, y int")
    got = {(r.g, r.measure): r.value for r in exact_quantiles(df, ["x", "y"], [0.5], ["g"]).collect()}
    for g in "abc":
        assert got[g, "x"] == pytest.approx(float(np.median([r[1] for r in rows if r[0] == g])))
        assert got[g, "y"] == float(np.median([r[2] for r in rows if r[0] == g]))


def test_a_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    assert {r.g: r.value for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()} == {None: 2.0, "a": 5.0}


@pytest.mark.parametrize("small", [1, 50])
def test_split_ranges_equal_linear_interpolation(spark, small):
    """Every range is split by digits until few values are left, whatever their sign and size."""
    rnd = random.Random(3)
    edge = [0.0, 5e-324, -5e-324, 2.2e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1.0, 2.0, 0.5, -1.0, 1.0000000000000002, 0.9999999999999999, 2.0**52, 2.0**53]
    values = edge + [rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randint(-300, 300) for _ in range(400)] + [3.0] * 100 + [rnd.gauss(0, 1) for _ in range(300)]
    df = spark.createDataFrame([(v, rnd.choice("ab")) for v in values], "v double, g string").cache()
    probs = [i / 20 for i in range(21)]
    got = {r.prob: r.value for r in exact_quantiles(df, ["v"], probs, small=small).collect()}
    ordered = sorted(values)
    for p in probs:
        at = p * (len(values) - 1)
        low, high = ordered[int(at)], ordered[min(len(values) - 1, int(at) + 1)]
        want = low if at == int(at) else low + (high - low) * (at - int(at))
        assert got[p] == pytest.approx(want, rel=1e-12, abs=0), p
    by = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["v"], [0.0, 1.0], ["g"], small=small).collect()}
    rows = df.collect()
    for g in "ab":
        assert (by[g, 0.0], by[g, 1.0]) == (min(r.v for r in rows if r.g == g), max(r.v for r in rows if r.g == g))


def test_infinities_are_the_ends(spark):
    df = spark.createDataFrame([(v,) for v in (float("inf"), float("-inf"), 1.0, 2.0, 3.0)], "v double")
    got = {r.prob: r.value for r in exact_quantiles(df, ["v"], [0.0, 0.5, 1.0], small=1).collect()}
    assert got == {0.0: float("-inf"), 0.5: 2.0, 1.0: float("inf")}


def test_a_narrow_range_of_a_million_ids_is_split(spark):
    """Ids beside each other: no range that is put in order holds more than asked for."""
    df = spark.range(10**6).selectExpr("1000000000 + id AS v")
    values, asks, at = hit_ranges(df, ["v"], [0.25, 0.5, 0.75], small=1000)
    assert values.groupBy(*at).count().agg(F.max("count")).first()[0] <= 1000
    assert values.count() <= 6 * 1000 and asks.count() == 6
    got = {r.prob: r.value for r in exact_quantiles(df, ["v"], [0.25, 0.5, 0.75], small=1000).collect()}
    assert got == {p: 1e9 + p * (10**6 - 1) for p in (0.25, 0.5, 0.75)}


def test_nothing_to_order(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]).collect() == []


def test_describe(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "v double")
    r = describe_numeric(df, ["v"]).first()
    assert (r["count"], r.min, r.q1, r.median, r.q3, r.max, r.fence_low, r.fence_high) == (5, 1, 2, 3, 4, 100, -1, 7)
