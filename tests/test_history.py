"""Stops that change from month to month."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tapflow.operators import enrich, history

KEY = ["stop_id", "region_code", "mode"]
SNAPSHOT = "ym string, stop_id long, region_code string, mode string, stop_name string, gps_x double, gps_y double"


def shots(spark, rows):
    return spark.createDataFrame([(ym, s, "R", "T", name, x, y) for ym, s, name, x, y in rows], SNAPSHOT)


def test_versions_merge_equal_months_and_end_where_a_stop_is_missing(spark):
    rows = [("202401", 1, "a", 127.0, 37.0), ("202402", 1, "a", 127.0, 37.0), ("202403", 1, "b", 127.0, 37.0)]  # renamed
    rows += [("202401", 2, "c", 127.0, 37.0), ("202403", 2, "c", 127.0, 37.0)]  # gone for a month
    rows += [("202402", 3, None, None, 37.0), ("202403", 3, None, None, 37.0)]  # new, null is a state
    got = {(r.stop_id, r.valid_from, r.valid_to, r.stop_name) for r in history.versions(shots(spark, rows), KEY).collect()}
    assert got == {
        (1, "202401", "202403", "a"), (1, "202403", "999999", "b"),
        (2, "202401", "202402", "c"), (2, "202403", "999999", "c"),
        (3, "202402", "999999", None),
    }
    assert history.versions(shots(spark, []), KEY).count() == 0


def test_each_month_has_the_last_snapshot_up_to_it(spark):
    draw = random.Random(4)
    months = ["202401", "202403", "202404", "202407"]
    table = {(m, s): (draw.choice("ab"), draw.choice([127.0, 127.1])) for m in months for s in range(30) if draw.random() < 0.8}
    rows = [(m, s, name, x, 37.0) for (m, s), (name, x) in table.items()]
    held = history.versions(shots(spark, rows), KEY)
    asked = ["202312", *[f"2024{m:02d}" for m in range(1, 10)]]
    trips = spark.createDataFrame([(m, s) for m in asked for s in range(31)], "ym string, board_stop long").withColumns({"board_region": F.lit("R"), "board_mode": F.lit("T")})
    got = {(r.ym, r.board_stop): (r.board_stop_name, r.board_gps_x) for r in enrich.enrich_stops(trips, held, ["stop_name", "gps_x"], ("board",), "ym").collect()}
    assert len(got) == len(asked) * 31
    for (m, s), seen in got.items():
        last = max((x for x in months if x <= m), default=None)
        assert seen == table.get((last, s), (None, None)), (m, s)
    opened = {(r.ym, r.stop_id): (r.stop_name, r.gps_x) for r in history.of_months(held, asked).collect()}
    assert opened == {k: v for k, v in got.items() if v != (None, None)}


def test_history_is_cleaned_per_version(spark):
    rows = [("202401", 1, "a", 37.5, 127.0), ("202402", 1, "a", 127.0, 37.5), ("202403", 1, "a", None, 37.5)]
    rows += [("202401", 1, "z", 1.0, 1.0)]  # a copy in one extract
    got = {(r.valid_from, r.valid_to, r.stop_name, r.gps_x, r.y_fixed) for r in history.stop_history(shots(spark, rows)).collect()}
    assert got == {("202401", "202402", "a", 127.0, 1), ("202402", "202403", "a", 127.0, 0)}


def test_a_merged_station_differs_by_month(spark):
    rows = [("202401", 1, "x", 127.0, 37.0), ("202401", 2, "y", 127.0, 37.0), ("202402", 1, "x", 127.0, 37.0), ("202402", 2, "x", 127.0, 37.0)]
    stops = history.of_months(history.versions(shots(spark, rows), KEY), ["202401", "202402"])
    mapping = enrich.transfer_map_from_names(stops, month=("ym",))
    trips = spark.createDataFrame([("202401", 2, 1), ("202402", 2, 1)], "ym string, board_stop long, alight_stop long")
    trips = trips.withColumns({f"{e}_{c}": F.lit(v) for e in ("board", "alight") for c, v in (("region", "R"), ("mode", "T"))})
    got = {(r.ym, r.board_stop, r.alight_stop) for r in enrich.canonicalise_stops(trips, mapping, ("ym",)).collect()}
    assert got == {("202401", "2", "1"), ("202402", "1", "1")}
