from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tapflow.functions import geo
from tapflow.operators import spatial


def test_projection_goldens(spark):
    df = spark.createDataFrame([(127.5, 38.0), (127.07, 37.37), (None, 37.0)], "lon double, lat double")
    got = geo.project(df, "lon", "lat").collect()
    assert (got[0].x_5179, got[0].y_5179) == (1000000.0, 2000000.0)
    assert round(got[1].x_5179, 3) == 961926.379 and round(got[1].y_5179, 3) == 1930190.654
    assert got[2].x_5179 is None and got[2].y_5179 is None


def test_grid_goldens(spark):
    df = spark.createDataFrame([("CG6375150378",)], "g string")
    x, y = geo.grid_metres(F.col("g"))
    row = df.select(x.alias("x"), y.alias("y"), geo.grid_wkt(F.col("g")).alias("wkt"), geo.local_grid(F.col("g")).alias("k")).first()
    assert (row.x, row.y, row.wkt, row.k) == (963751, 1950378, "POINT (963751 1950378)", "다사6375150378")
    back = spark.createDataFrame([(963751.9, 1950378.2)], "x double, y double")
    assert back.select(geo.grid_cell(F.col("x"), F.col("y"))).first()[0] == "CG6375150378"


def test_bad_grids(spark):
    bad = [None, "CG637515037", "ZG6375150378", "CZ6375150378", "CG63x5150378", "CG6375 50378", ""]
    df = spark.createDataFrame([(g,) for g in bad], "g string")
    assert [r[0] for r in df.select(geo.grid_wkt(F.col("g"))).collect()] == [None] * len(bad)


def test_grid_round_trip_inside_the_covered_area(spark):
    rnd = random.Random(7)
    pts = [(rnd.uniform(700000, 1399999), rnd.uniform(1400000, 2099999)) for _ in range(500)]
    df = spark.createDataFrame(pts, "x double, y double").withColumn("g", geo.grid_cell(F.col("x"), F.col("y")))
    gx, gy = geo.grid_metres(F.col("g"))
    for r in df.select("x", "y", gx.alias("gx"), gy.alias("gy")).collect():
        assert (r.gx, r.gy) == (math.floor(r.x), math.floor(r.y))


def test_grid_clips_outside(spark):
    df = spark.createDataFrame([(500000.0, 1000.0), (2000000.0, 9999999.0)], "x double, y double")
    assert [r[0] for r in df.select(geo.grid_cell(F.col("x"), F.col("y"))).collect()] == ["AB0000001000", "GH0000099999"]


def test_rectangle(spark):
    df = spark.createDataFrame([(127.0, 37.0, 127.5, 37.25), (None, 1.0, 1.0, 1.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.rectangle_wkt(*[F.col(c) for c in "abcd"])).collect()]
    ring = "127.000000 37.000000, 127.000000 37.250000, 127.500000 37.250000, 127.500000 37.000000, 127.000000 37.000000"
    assert got == [f"POLYGON (({ring}))", None]


@pytest.fixture(scope="module")
def scene(spark):
    rnd = random.Random(3)
    # A third of the points share one small square.
    pts = [(i, rnd.uniform(0, 100) if i % 3 == 0 else rnd.uniform(-40000, 40000), rnd.uniform(0, 100) if i % 3 == 0 else rnd.uniform(-40000, 40000)) for i in range(300)]
    sites = [(i, rnd.uniform(-9000, 9000), rnd.uniform(-9000, 9000)) for i in range(25)]
    sites.append((99, sites[0][1], sites[0][2]))
    return (
        pts,
        sites,
        spark.createDataFrame([*pts, (1000, None, 1.0)], "pid int, x double, y double"),
        spark.createDataFrame(sites, "site_id int, x double, y double"),
    )


def brute(pts, sites):
    return {p: min((math.sqrt((x - sx) ** 2 + (y - sy) ** 2), s) for s, sx, sy in sites) for p, x, y in pts}


def test_nearest_site_unbounded(scene):
    pts, sites, pdf, sdf = scene
    got = {r.pid: r for r in spatial.nearest_site(pdf, sdf, key=["pid"], x="x", y="y", first_ring=500.0).collect()}
    assert len(got) == 301 and got[1000].nearest_site is None
    for p, (d, s) in brute(pts, sites).items():
        assert got[p].nearest_site == s and got[p].site_distance == pytest.approx(d, abs=1e-9)


def test_nearest_site_bounded(scene):
    pts, sites, pdf, sdf = scene
    got = {r.pid: r.nearest_site for r in spatial.nearest_site(pdf, sdf, 3000.0, key=["pid"], x="x", y="y").collect()}
    assert {p: got[p] for p in got if p < 1000} == {p: s if d <= 3000 else None for p, (d, s) in brute(pts, sites).items()}


def test_nearest_site_without_sites(scene):
    _, _, pdf, sdf = scene
    got = spatial.nearest_site(pdf, sdf.where("false"), key=["pid"], x="x", y="y").collect()
    assert len(got) == 301 and all(r.nearest_site is None for r in got)


def test_within_radius(scene):
    pts, sites, pdf, sdf = scene
    centres = sdf.withColumnRenamed("site_id", "centre_id")
    got = {(r.pid, r.centre_id) for r in spatial.within_radius(pdf, centres, 2500.0, x="x", y="y").collect()}
    want = {(p, s) for p, x, y in pts for s, sx, sy in sites if math.sqrt((x - sx) ** 2 + (y - sy) ** 2) <= 2500.0}
    assert got == want and want


def test_decode_can_drop_cells(spark):
    df = spark.createDataFrame([("CG6375150378", None)], "board_grid string, alight_grid string")
    assert spatial.decode_grid_od(df, drop_grid=True).columns == ["board_wkt", "alight_wkt"]


@pytest.mark.parametrize("where", ["remote", "among", "one spot"])
def test_points_meet_few_of_many_sites(spark, monkeypatch, where):
    """A thousand sites, most of them in one square: no cell of sites that a point is measured against holds many."""
    rnd = random.Random(where)
    sites = [(i, rnd.uniform(0, 800), rnd.uniform(0, 800)) for i in range(900)] + [(1000 + i, rnd.uniform(-20000, 20000), rnd.uniform(-20000, 20000)) for i in range(100)]
    spread = {"remote": (100_000, 140_000), "among": (0, 800), "one spot": (300, 300)}[where]
    pts = [(i, rnd.uniform(*spread), rnd.uniform(*spread)) for i in range(300)]
    tables = [spark.createDataFrame(pts, "pid int, x double, y double"), spark.createDataFrame(sites, "site_id int, x double, y double")]
    seen, plain = [], spatial.candidate_cells

    def counted(here, places, *rest):
        out = plain(here, places, *rest)
        for level, pairs in out:
            seen.append((pairs.agg(F.max("_n")).first()[0] or 0, spatial._at(here, level).join(pairs, (F.col("_cx") == F.col("_px")) & (F.col("_cy") == F.col("_py"))).agg(F.sum("_n")).first()[0] or 0))
        return out

    monkeypatch.setattr(spatial, "candidate_cells", counted)
    got = {r.pid: (r.nearest_site, r.site_distance) for r in spatial.nearest_site(*tables, key=["pid"], x="x", y="y", leaf=8).collect()}
    for p, (d, s) in brute(pts, sites).items():
        assert got[p] == (s, pytest.approx(d, abs=1e-9))
    assert max(n for n, _ in seen) <= 8
    assert sum(m for _, m in seen) < 0.1 * len(pts) * len(sites)


def test_sites_at_one_place_and_points_on_them(spark):
    sites = spark.createDataFrame([(i, 5.0, 5.0) for i in range(200, 0, -1)], "site_id int, x double, y double")
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 1e7, -1e7), (3, None, None)], "pid int, x double, y double")
    got = {r.pid: (r.nearest_site, r.site_distance) for r in spatial.nearest_site(pts, sites, key=["pid"], x="x", y="y", leaf=1).collect()}
    assert got[1] == (1, 0.0) and got[2][0] == 1 and got[3] == (None, None)
