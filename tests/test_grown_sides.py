"""Tables that are small on disk and large in memory: sides that grow with the data are never broadcast."""

from __future__ import annotations

import math

import pytest

from pyspark.sql import functions as F

from tapflow.operators import anchors, catchment, clean, enrich, history, od, ordering, spatial

STOP = "stop_id bigint, region_code string, mode string, stop_name string, x_5179 double, y_5179 double, cell bigint"


@pytest.fixture
def sides(spark, tmp_path):
    stops = spark.createDataFrame([(1, "R0", "T", "a", 0.0, 0.0, 7), (2, "R0", "T", "b", 900.0, 0.0, 8), (3, "R0", "T", "b", 50.0, 0.0, 8)], STOP)
    stops.write.parquet(f"{tmp_path}/stops")
    trips = spark.createDataFrame(
        [("c", 1, "R0", "T", 2, "R0", "T", "202401", 60.0, 5.0), ("d", 9, "R0", "T", None, "R0", "T", "202402", 60.0, 5.0), (None, 1, "R0", "T", 3, "R0", "T", "202401", 60.0, 5.0)],
        "card_id string, board_stop bigint, board_region string, board_mode string, alight_stop bigint, alight_region string, alight_mode string, ym string, total_ride_sec double, total_distance double",
    )
    trips.write.parquet(f"{tmp_path}/trips")
    return spark.read.parquet(f"{tmp_path}/trips"), spark.read.parquet(f"{tmp_path}/stops")


def broadcasts(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_stops_and_cells_of_trips(sides):
    trips, stops = sides
    named = enrich.enrich_stops(trips, stops, ["stop_name", "cell"])
    assert broadcasts(named) == 0
    assert {(r.card_id, r.board_stop_name, r.alight_stop_name) for r in named.collect()} == {("c", "a", "b"), ("d", None, None), (None, "a", "b")}
    cells = trips.sparkSession.createDataFrame([("c", 7, 8)], "card_id string, home_cell bigint, work_cell bigint")
    assert broadcasts(enrich.commuter_trips(trips, cells)) == 0
    pairs = od.pair_stats(named, cells)
    assert broadcasts(pairs) == 0
    assert [(r.card_id, r.live_stop, r.work_stop, r.to_work_frequency) for r in pairs.collect()] == [("c", 1, 2, 1)]
    assert broadcasts(anchors.with_cells(trips, stops, "cell")) == 0


def test_stops_of_months(sides):
    trips, stops = sides
    shots = stops.select("stop_id", "region_code", "mode", "stop_name").withColumn("ym", F.explode(F.array(F.lit("202401"), F.lit("202402"))))
    held = history.versions(shots, ["stop_id", "region_code", "mode"])
    named = enrich.enrich_stops(trips, held, ["stop_name"], month="ym")
    # The months alone, one row per snapshot, for each end.
    assert broadcasts(named) == 2
    assert {(r.card_id, r.board_stop_name, r.alight_stop_name) for r in named.collect()} == {("c", "a", "b"), ("d", None, None), (None, "a", "b")}


def test_audits_maps_and_stop_sets(sides):
    trips, stops = sides
    key = {"board_stop": "stop_id", "board_region": "region_code", "board_mode": "mode"}
    assert broadcasts(enrich.unmatched_rows(trips, stops, key)) == 0
    mapping = enrich.transfer_map_from_names(stops)
    assert broadcasts(enrich.canonicalise_stops(trips, mapping)) == 0
    for how in ("board", "alight", "both", "either"):
        assert broadcasts(clean.touching(trips, stops, how)) == 0
    assert broadcasts(catchment.mean_ride(trips, stops)) == 0


def test_places(sides):
    _, stops = sides
    near = spatial.within_radius(stops.drop("cell"), stops.select(F.col("stop_id").alias("centre_id"), "x_5179", "y_5179"), 100.0)
    assert broadcasts(near) == 0
    assert {(r.stop_id, r.centre_id, r.distance_m) for r in near.collect()} == {(1, 1, 0.0), (1, 3, 50.0), (2, 2, 0.0), (3, 3, 0.0), (3, 1, 50.0)}
    sites = stops.where("stop_id > 1").select(F.col("stop_id").alias("site_id"), "x_5179", "y_5179")
    found = spatial.nearest_site(stops, sites, key=["stop_id", "region_code", "mode"])
    assert broadcasts(found) == 0
    assert {(r.stop_id, r.nearest_site, r.site_distance) for r in found.collect()} == {(1, 3, 50.0), (2, 2, 0.0), (3, 3, 0.0)}


def test_a_point_gets_a_row_per_cell_of_sites(spark, monkeypatch):
    """Of 64 sites in one cell a point keeps the nearest before rows are shuffled; equal distances take the lowest id."""
    met = []
    plain = spatial.grown
    monkeypatch.setattr(spatial, "grown", lambda df: met.append(df) or plain(df))
    points = spark.createDataFrame([(i, float(i % 10), 0.0) for i in range(100)], "k int, x_5179 double, y_5179 double")
    sites = spark.createDataFrame([(i, float(i % 8), 1.0 + i // 8) for i in range(64)], "site_id int, x_5179 double, y_5179 double")
    got = {r.k: (r.nearest_site, round(r.site_distance, 6)) for r in spatial.nearest_site(points, sites, key=["k"]).collect()}
    brute = {i: min((((i % 10 - s % 8) ** 2 + (1 + s // 8) ** 2) ** 0.5, s) for s in range(64)) for i in range(100)}
    assert got == {i: (s, round(d, 6)) for i, (d, s) in brute.items()}
    assert any("_sites" in df.columns and df.count() < 64 for df in met)


def test_a_point_gets_a_row_per_lot_of_cells(spark, monkeypatch):
    """Points amid a ring of sites meet all their cells: rows of a point are put together before they are sorted."""
    met = []
    plain = spatial.grown
    monkeypatch.setattr(spatial, "grown", lambda df: met.append(df) or plain(df))
    ring = [(10000 * math.cos(math.radians(10 * s)), 10000 * math.sin(math.radians(10 * s))) for s in range(36)]
    spots = {i: (i % 10 / 10, i // 10 / 10) for i in range(100)}
    points = spark.createDataFrame([(i, *p) for i, p in spots.items()], "k int, x_5179 double, y_5179 double")
    sites = spark.createDataFrame([(s, *p) for s, p in enumerate(ring)], "site_id int, x_5179 double, y_5179 double")
    got = {r.k: r.site_distance for r in spatial.nearest_site(points, sites, key=["k"]).collect()}
    assert got == pytest.approx({i: min(math.dist(p, q) for q in ring) for i, p in spots.items()}, abs=1e-9)
    cells = sum(df.count() for df in met if {"_qx", "_sites"} <= {*df.columns} and "_cx" not in df.columns)
    rows = sum(df.count() for df in met if {"_cx", "_sites"} <= {*df.columns})
    assert cells > 24 and rows == math.ceil(cells / spatial.LOT)


def test_rows_of_a_file_are_dealt_before_they_are_sorted(spark, tmp_path):
    rows = [(k, v, n) for k in (1, 2, None) for v in ("b", "a", None) for n in (2.0, 1.0)]
    spark.createDataFrame(rows * 3, "k int, v string, n double").coalesce(1).write.parquet(f"{tmp_path}/rows")
    one = ordering.dedup(spark.read.parquet(f"{tmp_path}/rows"), ["k"], ["v", "n"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    # Between the file and the first sort.
    assert "Exchange" in plan[plan.index("Partial"):]
    assert sorted(map(tuple, one.collect()), key=str) == [(1, "a", 1.0), (2, "a", 1.0), (None, "a", 1.0)]
