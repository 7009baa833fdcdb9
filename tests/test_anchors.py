from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapflow.operators import anchors as ops

from .conftest import TRIP_DDL, trip

DDL = "location_type string, card_id string, stop_id bigint, region_code string, mode string, stop_name string, x double, y double, event_ts timestamp_ntz"
START = dt.datetime(2025, 1, 6, 6)


def rows(card, visits, kind="residence"):
    """``visits``: (stop, x, y) in order of time."""
    return [(kind, card, s, "R0", "T", f"n{s}", x, y, START + dt.timedelta(minutes=i)) for i, (s, x, y) in enumerate(visits)]


def found(spark, data, **kw):
    df = ops.anchors(spark.createDataFrame(data, DDL), **kw)
    return sorted((r.card_id, r.location_type, r.stop_id, r.confidence, r.cluster_size, r.total_trips) for r in df.collect())


PATHS = pytest.mark.parametrize("small_card", [ops.SMALL_CARD, 0], ids=["row", "joins"])


@PATHS
def test_named_cases(spark, small_card):
    far = 100000.0
    data = [
        *rows("clean", [(1, 0.0, 0.0)] * 12),
        *rows("few", [(1, 0.0, 0.0)] * 9),
        *rows("scatter", [(i, i * 900.0, 0.0) for i in range(12)]),
        *rows("two_works", [(1, 0.0, 0.0)] * 11 + [(2, far, 0.0)] * 12),
        *rows("tie", [(2, far, 0.0), *[(1, 0.0, 0.0)] * 11, *[(2, far, 0.0)] * 10]),
        *rows("near", [(1, 0.0, 0.0), (2, 500.0, 0.0)] * 6),
        *rows("low", [(1, 0.0, 0.0)] * 10 + [(i, i * far, 0.0) for i in range(2, 13)]),
        *rows("half", [(1, 0.0, 0.0)] * 10 + [(i, i * far, 0.0) for i in range(2, 12)]),
        *rows("unknown", [(1, 0.0, 0.0)] * 10 + [(9, None, None)] * 5),
        *rows("edge", [(1, 0.0, 0.0)] * 10 + [(2, 800.0, 0.0), (3, 1600.5, 0.0)]),
    ]
    got = found(spark, data, small_card=small_card)
    assert got == sorted(
        [
            ("clean", "residence", 1, 1.0, 12, 12),
            ("two_works", "residence", 2, 0.52, 12, 23),
            ("tie", "residence", 2, 0.5, 11, 22),
            ("near", "residence", 1, 1.0, 12, 12),
            ("near", "residence", 2, 1.0, 12, 12),
            ("low", "residence", 1, 0.48, 10, 21),
            ("half", "residence", 1, 0.5, 10, 20),
            ("unknown", "residence", 1, 1.0, 10, 10),
            # 800 m is within reach; the last stop is not core's neighbour.
            ("edge", "residence", 1, 0.92, 11, 12),
            ("edge", "residence", 2, 0.92, 11, 12),
        ]
    )


def brute_force(visits, eps, min_rows):
    """Row-by-row density clustering in order of time: (stops, size, total)."""
    pts = [(s, x, y) for s, x, y in visits if x is not None]
    near = [[j for j, q in enumerate(pts) if ((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2) ** 0.5 <= eps] for p in pts]
    label, cluster = [None] * len(pts), -1
    for i in range(len(pts)):
        if label[i] is not None or len(near[i]) < min_rows:
            continue
        cluster += 1
        label[i], todo = cluster, [i]
        while todo:
            k = todo.pop()
            if len(near[k]) < min_rows:
                continue
            for j in near[k]:
                if label[j] is None:
                    label[j] = cluster
                    todo.append(j)
    if cluster < 0:
        return None
    sizes = [label.count(c) for c in range(cluster + 1)]
    best = sizes.index(max(sizes))
    return {pts[i][0] for i in range(len(pts)) if label[i] == best}, sizes[best], len(pts)


@PATHS
def test_equals_row_by_row_clustering(spark, small_card):
    rnd = random.Random(11)
    data, want = [], []
    for c in range(40):
        width = rnd.choice([600, 2500, 6000])
        stops = [(i, rnd.uniform(0, width), rnd.uniform(0, width)) for i in range(rnd.randint(1, 25))]
        stops += [(100 + i, stops[i][1], stops[i][2]) for i in range(min(3, len(stops)))]
        visits = [rnd.choice(stops) for _ in range(rnd.randint(5, 60))]
        data += rows(f"c{c}", visits)
        out = brute_force(visits, 800.0, 10)
        if out:
            want += [(f"c{c}", s, out[1], out[2]) for s in out[0]]
    got = [(c, s, size, total) for c, _, s, _, size, total in found(spark, data, small_card=small_card)]
    assert got == sorted(want) and len({w[0] for w in want}) > 10


@PATHS
def test_long_chain_is_one_cluster(spark, small_card):
    visits = [(i, i * 700.0, 0.0) for i in range(60) for _ in range(10)]
    got = found(spark, rows("chain", visits), small_card=small_card)
    assert len(got) == 60 and {g[4] for g in got} == {600}


def test_one_card_may_hold_a_third_of_all_rows(spark):
    """The large card leaves the row path and changes nothing for others."""
    rnd = random.Random(5)
    big = [(i, rnd.uniform(0, 30000), rnd.uniform(0, 30000)) for i in range(300)]
    visits = [rnd.choice(big) for _ in range(3000)]
    data = rows("big", visits) + rows("clean", [(1, 0.0, 0.0)] * 12)
    got = found(spark, data)
    stops, size, total = brute_force(visits, 800.0, 10)
    assert {g[2] for g in got if g[0] == "big"} == stops
    assert {(g[4], g[5]) for g in got if g[0] == "big"} == {(size, total)}
    assert ("clean", "residence", 1, 1.0, 12, 12) in got


def test_eligibility_needs_both_windows(spark):
    data = rows("both", [(1, 0.0, 0.0)] * 10) + rows("both", [(2, None, None)] * 10, "office")
    data += rows("one", [(1, 0.0, 0.0)] * 30) + rows("one", [(2, 0.0, 0.0)] * 9, "office")
    visits = ops.candidate_visits(spark.createDataFrame(data, DDL))
    assert {r.card_id for r in ops.eligible_visits(visits).collect()} == {"both"}
    df = spark.createDataFrame(data, DDL)
    home, work = (df.where(F.col("location_type") == k) for k in ("residence", "office"))
    assert [r.card_id for r in ops.valid_cards(home, work).collect()] == ["both"]


def test_modal_ties_and_unknown_cells(spark):
    base = dt.datetime(2025, 1, 6, 8)
    data = [("a", 5, base), ("a", 3, base), ("b", None, base), ("b", None, base), ("b", 1, base), ("c", 1, base.replace(hour=13))]
    df = spark.createDataFrame(data, "card_id string, cell bigint, ts timestamp_ntz")
    got = sorted((r.card_id, r.m or 0, r.freq) for r in ops.modal_cell(df, "card_id", "cell", "ts", (6, 12), "m").collect())
    assert got == [("a", 3, 1), ("a", 5, 1), ("b", 0, 2)]


def test_agreed_cells(spark):
    rows_ = [
        ("yes", "am_dep", 2), ("yes", "am_dep", 1), ("yes", "pm_arr", 1), ("yes", "pm_arr", 2),
        ("yes", "am_arr", 9), ("yes", "pm_dep", 9),
        ("no", "am_dep", 1), ("no", "pm_arr", 2), ("no", "am_arr", 9), ("no", "pm_dep", 9),
        ("null", "am_dep", None), ("null", "pm_arr", None), ("null", "am_arr", 9), ("null", "pm_dep", 9),
    ]
    df = spark.createDataFrame(rows_, "card_id string, win string, cell bigint")
    assert [tuple(r) for r in ops.agreed_cells(df).collect()] == [("yes", 1, 9)]


def test_candidates_read_each_table_once(spark, tmp_path):
    rows = [trip("c", 1, 2, f"2025-01-{d:02} 08:00:00", f"2025-01-{d:02} 18:00:00", str(d)) for d in range(1, 32)]
    rows += [trip("few", 2, 1, "2025-01-07 09:00:00", "2025-01-07 09:30:00"), trip(None, 1, 9, "2025-01-07 11:00:00", "2025-01-07 12:00:00")]
    spark.createDataFrame(rows, TRIP_DDL).write.parquet(f"{tmp_path}/trips")
    stops = [(i, "R0", "T", f"s{i}", 37.0, 127.0) for i in (1, 2)]
    spark.createDataFrame(stops, "stop_id long, region_code string, mode string, stop_name string, gps_y double, gps_x double").write.parquet(f"{tmp_path}/stops")
    trips, dim = spark.read.parquet(f"{tmp_path}/trips"), spark.read.parquet(f"{tmp_path}/stops")
    off = spark.createDataFrame([], "holiday_date date")
    got = ops.candidates(trips, dim, off)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 + off._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    sides = [ops.candidate_stops(trips, dim, off, kind).withColumn("location_type", F.lit(kind)) for kind in ("residence", "office")]
    both = sides[0].unionByName(sides[1])
    assert got.exceptAll(both.select(*got.columns)).isEmpty() and both.select(*got.columns).exceptAll(got).isEmpty()
    plan = ops.enough_rows(ops.window_rows(trips, off))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    cards = [r.card_id for r in ops.enough_rows(got).collect()]
    assert cards == [r.card_id for r in ops.valid_cards(*sides).collect()]
