"""Loads that replace months all at once, the daily cube, and the fit to a normal."""

from __future__ import annotations

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tapflow.functions.numbers import normal_cdf
from tapflow.operators import od, quality
from tapflow.plans import jobs
from tapflow.sources import published
from tests.conftest import TRIP_DDL, trip
from tests.test_io import od_rows


def rows(spark, *items):
    return spark.createDataFrame(items, "ym string, day int, n long")


def seen(spark, path):
    return sorted(tuple(r) for r in published.read(spark, path).collect())


def test_months_are_replaced_and_named_ones_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    published.load(rows(spark, ("202501", 1, 1), ("202501", 2, 2), ("202502", 1, 3)), path, ["ym", "day"])
    published.load(rows(spark, ("202501", 3, 9)), path, ["ym", "day"])
    assert seen(spark, path) == [("202501", 3, 9), ("202502", 1, 3)]
    published.load(rows(spark, ("202503", 1, 4)), path, ["ym", "day"], named=["202502", "202503"])
    assert seen(spark, path) == [("202501", 3, 9), ("202503", 1, 4)]
    assert published.read(spark, path).dtypes == [("ym", "string"), ("day", "int"), ("n", "bigint")]
    before = seen(spark, path)
    gone = published.vacuum(spark, path)
    assert len(gone) == 3 and seen(spark, path) == before
    published.load(rows(spark).where("false"), path, ["ym", "day"], named=["202501", "202503"])
    assert seen(spark, path) == []
    with pytest.raises(FileNotFoundError):
        published.read(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_job_that_dies_leaves_the_old_months(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    published.load(rows(spark, ("202501", 1, 1), ("202502", 1, 2)), path, ["ym", "day"])
    old = seen(spark, path)
    bad = rows(spark, ("202501", 1, 100))
    if step == "write":
        bad = bad.withColumn("n", F.when(F.col("n") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("long"))
    else:
        monkeypatch.setattr(published, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        published.load(bad, path, ["ym", "day"], named=["202501", "202502"])
    assert seen(spark, path) == old
    monkeypatch.undo()
    # The next load works, and what the dead one left can go.
    published.load(rows(spark, ("202502", 1, 5)), path, ["ym", "day"], named=["202502"])
    published.vacuum(spark, path)
    assert seen(spark, path) == [("202501", 1, 1), ("202502", 1, 5)]
    assert sum(name.endswith(".parquet") for _, _, names in os.walk(f"{path}/versions") for name in names) == 2


def test_a_row_of_another_month_stops_the_load(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="not among those named"):
        published.load(rows(spark, ("202501", 1, 1)), path, ["ym", "day"], named=["202502"])
    assert published.pointer(spark, path) is None


def test_cube_counts_cards_and_measures_apart(spark):
    draw = random.Random(2)
    trips = []
    for i in range(300):
        day = draw.choice([6, 7])
        at = f"2025-01-{day:02d} {draw.choice([8, 9]):02d}:{draw.randint(0, 59):02d}:00"
        base = list(trip(draw.choice(["a", "b", "c", None]), draw.choice([1, 2, None]), 3, at, f"2025-01-{day:02d} 10:00:00", txn=str(i)))
        base[-3:] = draw.choice([1.0, 2.0, None]), float(draw.randint(1, 9)), draw.randint(0, 2)
        trips.append(tuple(base))
    df = spark.createDataFrame(trips, TRIP_DDL)
    out = od.od_hourly(df)
    cells = {}
    for t in trips:
        cells.setdefault((t[0], t[5].hour, t[3]), []).append(t)
    got = {(r.op_date, r.hour, r.board_stop): r for r in out.collect()}
    assert set(got) == set(cells)
    for key, ts in cells.items():
        r, far = got[key], sorted(t[-3] for t in ts if t[-3] is not None)
        assert (r.use_count, r.unique_use_count) == (len(ts), len({t[1] for t in ts} - {None}))
        assert r.distance_median == ((far[(len(far) - 1) // 2] + far[len(far) // 2]) / 2 if far else None)
        assert r.time_avg == pytest.approx(sum(t[-2] for t in ts) / len(ts))
    # Percentile maps are made per cell: the aggregate over cards carries none.
    plan = od.od_hourly(df)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.split("\n") if "card_id" in line and "percentile" in line.lower()]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_normal_cdf_equals_the_error_function(spark):
    zs = [-40.0, -37.5, -12.0, -7.2, -7.0, -3.3, -1e-9, 0.0, 0.5, 1.96, 6.9, 7.5, 38.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", normal_cdf(F.col("z")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(0.5 * math.erfc(-r.z / math.sqrt(2)), rel=1e-7, abs=1e-15)


@pytest.mark.parametrize("kind", ["normal", "ties", "skewed"])
def test_fit_equals_brute_force(spark, kind):
    draw = random.Random(kind)
    values = [{"normal": draw.gauss(5, 2), "ties": float(draw.randint(0, 6)), "skewed": draw.expovariate(1)}[kind] for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    r = quality.ks_normal(df, "v", parts=6).first()
    n, mean = len(values), sum(values) / len(values)
    std = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1))
    share = [0.5 * math.erfc(-(v - mean) / std / math.sqrt(2)) for v in sorted(values)]
    d = max(max((i + 1) / n - p, p - i / n) for i, p in enumerate(share))
    t = d * math.sqrt(n)
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 200))
    assert (r.n, r.mean, r["std"]) == (n, pytest.approx(mean), pytest.approx(std))
    assert r.statistic == pytest.approx(d, abs=1e-9) and r.p_value == pytest.approx(min(1, max(0, p)), abs=1e-6)
    assert r.is_normal is (kind == "normal")


def test_no_spread_is_an_error(spark):
    with pytest.raises(ValueError, match="too few"):
        quality.ks_normal(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v")
    with pytest.raises(ValueError, match="too few"):
        quality.ks_normal(spark.createDataFrame([], "v double"), "v")


def test_monthly_od_is_published_at_once(spark, tmp_path):
    path, off = str(tmp_path / "od"), spark.createDataFrame([(dt.date(2025, 1, 1),)], "holiday_date date")
    jobs.publish_od(od_rows(spark), off, path, at_once=True)
    jobs.publish_od(od_rows(spark, "202502"), off, path, at_once=True)
    got = jobs.publish_od(od_rows(spark, "202503"), off, path, ["202502", "202503"], at_once=True)
    assert sorted(r.standard_ym for r in got.collect()) == ["202501", "202503"]
