from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from tapflow.operators import dwell, od, ordering
from tests.conftest import TRIP_DDL, trip


@pytest.fixture(scope="module")
def stops(spark):
    rows = [(i, "R0", "T", f"s{i}", "d", 127.0, 37.0, c) for i, c in [(1, 10), (2, 20), (3, 30), (4, 40), (5, None)]]
    return spark.createDataFrame(
        rows,
        "stop_id bigint, region_code string, mode string, stop_name string, legal_dong string, gps_x double, gps_y double, cell_id bigint",
    )


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame([("c", 10, 20)], "card_id string, home_cell bigint, work_cell bigint")


def stay(spark, stops, cells, alight, board, until="2025-01-06 09:00:00"):
    data = [
        trip("c", 4, alight, "2025-01-06 08:00:00", "2025-01-06 08:30:00", "1"),
        trip("c", board, 4, until, "2025-01-08 09:30:00", "2"),
        trip("other", board, 4, until, "2025-01-08 09:30:00", "2"),
    ]
    return dwell.dwell_events(spark.createDataFrame(data, TRIP_DDL), cells, stops).collect()


@pytest.mark.parametrize(
    "alight, board, kind",
    [(1, 1, "live"), (2, 2, "work"), (3, 4, "play"), (1, 2, "other"), (5, 3, "other"), (3, 5, "other"), (9, 3, "other")],
)
def test_activity(spark, stops, cells, alight, board, kind):
    got = stay(spark, stops, cells, alight, board)
    assert [(r.stop_id, r.duration_type, r.minutes, r.persons) for r in got] == [(alight, kind, 15.0, 1.0), (board, kind, 15.0, 1.0)]


@pytest.mark.parametrize(
    "until, kept",
    [("2025-01-06 08:34:59", 0), ("2025-01-06 08:35:00", 2), ("2025-01-07 08:30:00", 2), ("2025-01-07 08:30:01", 0)],
)
def test_bounds(spark, stops, cells, until, kept):
    assert len(stay(spark, stops, cells, 1, 1, until)) == kept


def test_simple_variant_is_strict_and_unbounded(spark):
    def run(until):
        data = [
            trip("c", 1, 2, "2025-01-06 08:00:00", "2025-01-06 08:30:00", "1"),
            trip("c", 3, 4, until, "2025-01-09 10:00:00", "2"),
        ]
        return [r.minutes for r in dwell.dwell_events_simple(spark.createDataFrame(data, TRIP_DDL)).collect()]

    assert run("2025-01-06 08:40:00") == []
    assert run("2025-01-06 08:42:00") == [6.0, 6.0]
    assert run("2025-01-08 08:30:00") == [1440.0, 1440.0]


def many_trips(spark):
    rnd = random.Random(2)
    data = []
    for i in range(400):
        card = "hot" if i % 3 == 0 else f"c{rnd.randint(0, 9)}"
        day, hour, minute = rnd.randint(1, 9), rnd.randint(0, 22), rnd.randint(0, 59)
        b = f"2025-01-0{day} {hour:02d}:{minute:02d}:00"
        data.append(trip(card, rnd.randint(1, 4), rnd.randint(1, 4), b, f"2025-01-0{day} {hour + 1:02d}:{minute:02d}:30", str(i)))
    return spark.createDataFrame(data, TRIP_DDL).repartition(4)


@pytest.mark.parametrize("step, name", [(1, "lead"), (-1, "lag")])
@pytest.mark.parametrize("parts", [None, 1, 50])
def test_split_cards_give_the_plain_window(spark, step, name, parts):
    df = many_trips(spark)
    w = Window.partitionBy("card_id").orderBy("board_ts", "txn_id")
    move = F.lead if step == 1 else F.lag
    want = df.withColumns({"a": move("board_stop").over(w), "b": move("alight_ts").over(w)}).collect()
    got = ordering.with_neighbour(df, "card_id", ["board_ts", "txn_id"], {"a": "board_stop", "b": "alight_ts"}, step, parts)
    assert sorted(map(str, got.collect())) == sorted(map(str, want))


def test_null_cards_are_spread_over_ranges(spark):
    df = spark.range(20_000).select(F.lit(None).cast("string").alias("card_id"), F.col("id").alias("n"))
    dealt = ordering.dealt_in_order(df, "card_id", ["n"], 40)
    assert dealt.groupBy("_part").count().agg(F.max("count")).first()[0] < 2000
    got = ordering.with_neighbour(df, "card_id", ["n"], {"m": "n"}, 1, 40)
    assert got.where("m = n + 1").count() == 19_999


def test_halves_sum_to_the_whole_and_both_orders_agree(spark, stops):
    df = many_trips(spark)
    cells = spark.createDataFrame([("hot", 10, 20), ("c1", 30, 40)], "card_id string, home_cell bigint, work_cell bigint")
    events = dwell.dwell_events(df, cells, stops, parts=50)
    stats = dwell.dwell_stats(events, stops)
    early = events.join(stops.drop("cell_id"), ["stop_id", "region_code", "mode"], "left").groupBy(
        "op_date", "stop_id", "region_code", "mode", "duration_type", "stop_name", "legal_dong", "gps_x", "gps_y"
    ).agg(F.round(F.sum("minutes"), 6).alias("t"), F.median("minutes").alias("m"))
    late = stats.select(
        "op_date", "stop_id", "region_code", "mode", "duration_type", "stop_name", "legal_dong", "gps_x", "gps_y",
        F.round("total_minutes", 6).alias("t"), F.col("minutes_median").alias("m"),
    )
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect()))
    assert events.count() % 2 == 0 and events.count() > 50


def test_evening_is_the_mirrored_morning(spark, stops):
    day = "2025-01-06"
    there = [trip("c", 1, 2, f"{day} 08:00:00", f"{day} 08:30:00")]
    back = [trip("c", 2, 1, f"{day} 18:00:00", f"{day} 18:30:00")]
    cells = spark.createDataFrame([("c", 10, 20)], "card_id string, home_cell bigint, work_cell bigint")
    am = od.cell_commute_od(spark.createDataFrame(there, TRIP_DDL), cells, stops, "morning").collect()
    pm = od.cell_commute_od(spark.createDataFrame(back, TRIP_DDL), cells, stops, "evening").collect()
    assert am == pm and len(am) == 1 and am[0].live_station_id == 1


def anchors(spark, conf=1.0):
    rows = [("c", 1, "s1", "R0", "T", "residence", conf, 12, 12), ("c", 2, "s2", "R0", "T", "office", conf, 12, 12)]
    return spark.createDataFrame(
        rows,
        "card_id string, stop_id bigint, stop_name string, region_code string, transport_type string, location_type string, confidence double, cluster_size bigint, total_trips bigint",
    )


def test_match_commutes(spark):
    day = "2025-01-06"
    data = [
        trip("c", 1, 2, f"{day} 06:00:00", f"{day} 10:59:59", "am"),
        trip("c", 1, 2, f"{day} 05:59:59", f"{day} 07:00:00", "early"),
        trip("c", 1, 2, f"{day} 10:30:00", f"{day} 11:00:00", "late"),
        trip("c", 2, 1, f"{day} 16:00:00", f"{day} 23:00:00", "pm"),
        trip("c", 1, 2, f"{day} 17:00:00", f"{day} 17:30:00", "wrong way"),
        trip("d", 1, 2, f"{day} 07:00:00", f"{day} 07:30:00", "stranger"),
    ]
    df = spark.createDataFrame(data, TRIP_DDL)
    got = sorted((r.txn_id, r.trip_type) for r in od.match_commutes(df, anchors(spark)).collect())
    assert got == [("am", "morning"), ("pm", "evening")]
    assert od.match_commutes(df, anchors(spark, 0.5)).count() == 2
    assert od.match_commutes(df, anchors(spark, 0.48)).count() == 0


def test_transfer_stations_merge(spark):
    import datetime as dt

    day = "2025-01-06"
    df = spark.createDataFrame([trip("c", 1, 2, f"{day} 08:00:00", f"{day} 08:30:00")], TRIP_DDL)
    mapping = spark.createDataFrame([("1", "R0", "T", "77"), ("2", "R0", "B", "78")], "stop_id string, region_code string, mode string, canonical_stop_id string")
    off = spark.createDataFrame([(dt.date(2025, 1, 1),)], "holiday_date date")
    (row,) = od.commute_od(df, anchors(spark), mapping, off).collect()
    assert (row.board_stop, row.alight_stop, row.trips, row.trip_type) == ("77", "2", 1, "morning")
    assert (row.distance_avg, row.distance_median, row.time_avg, row.time_median) == (5000.0, 5000.0, 1200.0, 1200.0)
