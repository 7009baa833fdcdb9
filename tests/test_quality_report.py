"""The quality report as a whole."""

from __future__ import annotations

from registry import QUERIES
from tapflow.plans import jobs

from .conftest import TAP_DDL, leg


def test_report_counts_impossible_timestamps(spark):
    taps = spark.createDataFrame([leg(), leg(b="2025-01-09 08:00:00"), leg(b=None)], TAP_DDL)
    stops = spark.createDataFrame([(1, "R0", "T", 127.0, 37.0)], "stop_id long, region_code string, mode string, gps_x double, gps_y double")
    raw = spark.createDataFrame(
        [("20250106080000", "20250106"), ("20250106086130", "20250106"), ("202501062A0000", "20250106"), ("20250109080000", "20250106"), (None, "20250106")],
        "ts_text string, date_text string",
    )
    got = jobs.quality_report(taps, stops, stops.select("stop_id"), raw)["bad_timestamps"].first()
    assert tuple(got) == (3, 1, 2, 1)
    got = jobs.quality_report(taps, stops, stops.select("stop_id"))["bad_timestamps"].first()
    assert tuple(got) == (1, 0, 0, 1)


def test_catchment_query_holds_every_part(spark):
    rows = QUERIES["q_g8_catchment_report"](spark, "/root/testdata/sf0.01").collect()
    value = {(r["section"], r["item"]): r["value"] for r in rows}
    two_trip_days = sum(v for (s, _), v in value.items() if s == "hours")
    assert sum(v for (s, _), v in value.items() if s == "return_bins") == two_trip_days
    assert sum(v for (s, _), v in value.items() if s == "commuters") == value["funnel", "commuting.rows"]
    assert any(s == "commuters" for s, _ in value)
