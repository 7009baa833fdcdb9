from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tapflow.operators import clean
from tapflow.operators.trips import purpose_trips, purpose_trips_by_leg
from tests.conftest import TAP_DDL, leg


def roll(spark, rows, **kw):
    return purpose_trips(spark.createDataFrame(rows, TAP_DDL), **kw).collect()


def test_transfer_trip_skips_unknown_stops(spark):
    rows = [
        leg(no=0, board=None, alight=2, b="2025-01-06 08:00:00", a="2025-01-06 08:10:00"),
        leg(no=1, board=3, alight=4, b="2025-01-06 08:12:00", a="2025-01-06 08:20:00", mode_code=100),
        leg(no=2, board=5, alight=None, b="2025-01-06 08:25:00", a="2025-01-06 08:40:00"),
    ]
    (t,) = roll(spark, rows)
    assert (t.board_stop, t.alight_stop, t.board_mode, t.alight_mode) == (3, 4, "T", "T")
    assert (t.total_distance, t.total_ride_sec, t.max_transfers) == (3000.0, 3600.0, 2)
    assert str(t.board_ts) == "2025-01-06 08:00:00" and str(t.alight_ts) == "2025-01-06 08:40:00"


def test_unfinished_trip_and_child_drop(spark):
    rows = [leg(card="a", alight=None, a=None), leg(card="b", user_type=2), leg(card="c")]
    assert [t.card_id for t in roll(spark, rows)] == ["c"]
    assert sorted(t.card_id for t in roll(spark, rows, adults_only=False)) == ["b", "c"]


def test_last_leg_without_time_does_not_win(spark):
    rows = [
        leg(no=0, alight=2, a="2025-01-06 08:10:00"),
        leg(no=1, board=3, b="2025-01-06 08:12:00", alight=9, a=None, region_code="R9"),
    ]
    (t,) = roll(spark, rows)
    assert (t.alight_stop, t.alight_region, t.max_transfers) == (2, "R0", 1)


def test_order_of_rows_does_not_matter(spark):
    rows = [leg(no=i, board=10 + i, alight=20 + i, b=f"2025-01-06 {8 + i:02d}:00:00", a=f"2025-01-06 {8 + i:02d}:30:00") for i in range(4)]
    one = roll(spark, rows)
    two = purpose_trips(spark.createDataFrame(rows[::-1], TAP_DDL).repartition(3, "transfer_no")).collect()
    assert one == two and (one[0].board_stop, one[0].alight_stop) == (10, 23)


def test_by_leg_fans_out_on_duplicates_and_agrees_otherwise(spark):
    rows = [leg(no=0, board=1, alight=2), leg(no=1, board=3, alight=4, b="2025-01-06 08:30:00", a="2025-01-06 08:50:00")]
    df = spark.createDataFrame(rows, TAP_DDL)
    by_leg = purpose_trips_by_leg(df)
    cols = by_leg.columns
    assert by_leg.collect() == purpose_trips(df).select(cols).collect()
    assert purpose_trips_by_leg(spark.createDataFrame(rows + [rows[0]], TAP_DDL)).count() == 2


def test_mode_edges(spark):
    df = spark.createDataFrame([(c,) for c in (199, 200, 299, 300, None)], "code int")
    assert [r.mode for r in clean.with_mode(df, "code").collect()] == ["B", "T", "T", "B", "B"]
    extra = clean.with_mode(df, "code", (300,)).collect()
    assert [r.mode for r in extra] == ["B", "T", "T", "T", "B"]


def test_plan_has_one_exchange(spark):
    df = spark.createDataFrame([leg()], TAP_DDL)
    plan = purpose_trips(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_inverted(spark):
    rows = [
        leg(card="ok"),
        leg(card="back", b="2025-01-06 09:00:00"),
        leg(card="same", b="2025-01-06 09:00:00", board=2),
        leg(card="open", a=None),
    ]
    df = spark.createDataFrame(rows, TAP_DDL)
    assert sorted(r.card_id for r in clean.drop_inverted(df).collect()) == ["ok", "open"]
    assert [r.card_id for r in clean.inverted(df).collect()] == ["back"]


def test_touching(spark):
    df = spark.createDataFrame([leg(card="in", board=1, alight=2), leg(card="half", board=1, alight=7), leg(card="out", board=8, alight=9)], TAP_DDL)
    stops = spark.createDataFrame([(1,), (2,)], "stop_id bigint")
    got = {how: sorted(r.card_id for r in clean.touching(df, stops, how).collect()) for how in ("either", "both", "board", "alight")}
    assert got == {"either": ["half", "in"], "both": ["in"], "board": ["half", "in"], "alight": ["in"]}
    with pytest.raises(ValueError):
        clean.touching(df, stops, "never")


def test_legs_are_shuffled_once_by_the_trip_key(spark):
    out = purpose_trips_by_leg(spark.createDataFrame([leg(), leg(no=1)], TAP_DDL))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # One for legs with a key; those without are summed before theirs.
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_legs_without_a_key_or_number_match_nothing(spark):
    rows = [leg(), leg(no=1), leg(card=None), leg(card=None, no=2), leg(txn="9", no=None), leg(txn="8", no=3), leg(txn="7"), leg(txn="7"), leg(txn="7", no=1), leg(txn="7", no=1)]
    got = sorted((str(r.card_id), r.txn_id, str(r.board_stop), str(r.alight_stop), r.total_distance) for r in purpose_trips_by_leg(spark.createDataFrame(rows, TAP_DDL)).collect())
    want = [("None", "1", "None", "None", 2000.0), ("c", "1", "1", "2", 2000.0), *[("c", "7", "1", "2", 4000.0)] * 4, ("c", "8", "None", "2", 1000.0), ("c", "9", "None", "None", 1000.0)]
    assert got == want
    assert purpose_trips_by_leg(spark.createDataFrame([], TAP_DDL)).count() == 0
