"""W: neighbour rows, dwell time, round trips. A25 follows from W3."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapflow.operators import anchors as anchor_ops
from tapflow.operators import catchment, clean, dwell, enrich, ordering, spatial
from tapflow.operators.ordering import cards_with, nth_trip

from .aggregates import cell_stops, clean_stops, leg_trips_of, trips_of
from .catalog import query, rounded
from .joins import district_centres
from .standin import cte

_NEXT = ["board_stop", "board_ts", "board_region", "board_mode"]
_PREV = ["alight_stop", "alight_ts", "alight_region", "alight_mode"]


@query(
    "q_w1_with_next_trip",
    f"""
SELECT op_date, card_id, txn_id, alight_ts, {", ".join(f"lead({c}) OVER w AS next_{c}" for c in _NEXT)}
FROM trips WINDOW w AS (PARTITION BY card_id ORDER BY board_ts, txn_id, op_date, alight_ts NULLS FIRST, board_stop NULLS FIRST, alight_stop NULLS FIRST)
""",
    "trips",
)
def w1(spark, sf):
    return ordering.with_next_trip(trips_of(spark, sf)).select(
        "op_date", "card_id", "txn_id", "alight_ts", *[f"next_{c}" for c in _NEXT]
    )


@query(
    "q_w2_with_prev_trip",
    f"""
SELECT op_date, card_id, txn_id, board_ts, {", ".join(f"lag({c}) OVER w AS prev_{c}" for c in _PREV)}
FROM trips WINDOW w AS (PARTITION BY card_id ORDER BY board_ts, txn_id, op_date, alight_ts NULLS FIRST, board_stop NULLS FIRST, alight_stop NULLS FIRST)
""",
    "trips",
)
def w2(spark, sf):
    return ordering.with_prev_trip(trips_of(spark, sf)).select(
        "op_date", "card_id", "txn_id", "board_ts", *[f"prev_{c}" for c in _PREV]
    )


@query(
    "q_w1_with_next_trip_split",
    f"""
SELECT op_date, card_id, txn_id, alight_ts, {", ".join(f"lead({c}) OVER w AS next_{c}" for c in _NEXT)}
FROM trips WINDOW w AS (PARTITION BY card_id ORDER BY board_ts, txn_id, op_date, alight_ts NULLS FIRST, board_stop NULLS FIRST, alight_stop NULLS FIRST)
""",
    "trips",
)
def w1_split(spark, sf):
    """In so many ranges that most cards reach into several."""
    return ordering.with_next_trip(trips_of(spark, sf), parts=64).select(
        "op_date", "card_id", "txn_id", "alight_ts", *[f"next_{c}" for c in _NEXT]
    )


def dwell_views(source: str, cells: str, name: str) -> None:
    """Dwell events of commuters over tagged trips."""
    cte(
        name,
        f"""
WITH numbered AS (
  SELECT t.*, c.home_cell AS home, c.work_cell AS office, row_number() OVER (
    PARTITION BY card_id ORDER BY board_ts, txn_id, op_date, alight_ts NULLS FIRST, board_stop NULLS FIRST, alight_stop NULLS FIRST) AS no
  FROM {source} t JOIN {cells} c USING (card_id) WHERE NOT coalesce(board_ts > alight_ts, FALSE)),
stays AS (
  SELECT x.op_date, x.card_id, epoch(y.board_ts - x.alight_ts) AS gap,
    [{{'s': x.alight_stop, 'r': x.alight_region, 'm': x.alight_mode}}, {{'s': y.board_stop, 'r': y.board_region, 'm': y.board_mode}}] AS ends,
    [x.alight_cell, y.board_cell] AS cells, x.home, x.office
  FROM numbered x JOIN numbered y ON y.card_id = x.card_id AND y.no = x.no + 1
  WHERE x.alight_stop IS NOT NULL AND y.board_stop IS NOT NULL)
SELECT op_date, card_id, coalesce(list_filter(['live', 'work', 'play'], lambda kind, i: [
    list_distinct(cells) = [home] AND len(list_filter(cells, lambda q: q IS NULL)) = 0,
    list_distinct(cells) = [office] AND len(list_filter(cells, lambda q: q IS NULL)) = 0,
    len(list_filter(cells, lambda q: q <> home AND q <> office)) = 2][i])[1], 'other') AS duration_type,
  unnest(ends) AS place, CAST(gap AS DOUBLE) / 120 AS minutes, CAST(1 AS DOUBLE) AS persons
FROM stays WHERE gap BETWEEN 300 AND 86400
""",
        source,
        cells,
    )


dwell_views("tagged", "anchor_cells", "dwell_events")
DWELL_SELECT = "op_date, card_id, place.s AS stop_id, place.r AS region_code, place.m AS mode, duration_type"


def dwell_of(spark, sf, **extra):
    trips, stops = clean.drop_inverted(leg_trips_of(spark, sf)), cell_stops(spark, sf)
    return dwell.dwell_events(trips, anchor_ops.anchor_cells(trips, stops), stops, **extra)


@query(
    "q_w3_dwell_events",
    f"SELECT {DWELL_SELECT}, round(minutes, 6) AS minutes, persons FROM dwell_events",
    "dwell_events",
)
def w3(spark, sf):
    return rounded(dwell_of(spark, sf), "minutes")


cte(
    "dwell_simple",
    """
SELECT card_id, unnest([{'s': board_stop, 'r': board_region, 'm': board_mode},
    {'s': prev_stop, 'r': prev_region, 'm': prev_mode}]) AS place, gap / 60 / 2 AS minutes, 1.0::DOUBLE AS persons
FROM (SELECT *, CAST(date_diff('second', prev_ts, board_ts) AS DOUBLE) AS gap FROM
  (SELECT *, lag(alight_ts) OVER w AS prev_ts, lag(alight_stop) OVER w AS prev_stop, lag(alight_region) OVER w AS prev_region,
     lag(alight_mode) OVER w AS prev_mode FROM leg_trips
   WHERE board_ts IS NOT NULL AND alight_ts IS NOT NULL AND NOT board_ts > alight_ts
   WINDOW w AS (PARTITION BY card_id ORDER BY board_ts, txn_id, op_date, alight_ts NULLS FIRST, board_stop NULLS FIRST, alight_stop NULLS FIRST)))
WHERE gap / 60 / 2 > 5
""",
    "leg_trips",
)


@query(
    "q_w4_dwell_events_simple",
    """
SELECT card_id, place.s AS stop_id, place.r AS region_code, place.m AS mode, round(minutes, 6) AS minutes, persons
FROM dwell_simple
""",
    "dwell_simple",
)
def w4(spark, sf):
    return rounded(dwell.dwell_events_simple(leg_trips_of(spark, sf)), "minutes")


@query(
    "q_w4_dwell_stats_simple",
    """
SELECT d.*, s.stop_name, s.legal_dong, s.gps_x, s.gps_y FROM
 (SELECT place.s AS stop_id, place.r AS region_code, place.m AS mode, sum(persons) AS duration_count,
    round_even(round(sum(minutes), 6), 2) AS duration_total_min,
    round_even(round(avg(minutes), 6), 2) AS duration_mean_min,
    round_even(round(median(minutes), 6), 2) AS duration_median_min FROM dwell_simple
  WHERE place.s IS NOT NULL GROUP BY 1, 2, 3) d
LEFT JOIN raw_stops s ON d.stop_id = s.stop_id AND d.region_code = s.region_code AND d.mode = s.mode
""",
    "dwell_simple",
    "raw_stops",
)
def w4_stats(spark, sf):
    return dwell.dwell_stats_simple(dwell.dwell_events_simple(leg_trips_of(spark, sf)), cell_stops(spark, sf))


def dwell_stats_sql(events: str, stops: str) -> str:
    return f"""
SELECT d.*, s.stop_name, s.legal_dong, s.gps_x, s.gps_y FROM
 (SELECT op_date, place.s AS stop_id, place.r AS region_code, place.m AS mode, duration_type,
    round(sum(minutes), 6) AS total_minutes, sum(persons) AS total_persons, round(avg(minutes), 6) AS minutes_avg,
    round(median(minutes), 6) AS minutes_median FROM {events} GROUP BY ALL) d
LEFT JOIN {stops} s ON d.stop_id = s.stop_id AND d.region_code = s.region_code AND d.mode = s.mode
"""


DWELL_ROUNDED = ("total_minutes", "minutes_avg", "minutes_median")


@query("q_a25_dwell_stats", dwell_stats_sql("dwell_events", "raw_stops"), "dwell_events", "raw_stops")
def a25(spark, sf):
    return rounded(dwell.dwell_stats(dwell_of(spark, sf), cell_stops(spark, sf)), *DWELL_ROUNDED)


# --- n-th trips ---------------------------------------------------------------------------------

_NTH = """
SELECT op_date, card_id, txn_id, board_ts FROM trips
QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY board_ts, txn_id) = {n}
"""


@query("q_w5_nth_trip", f"SELECT 1 AS n, * FROM ({_NTH.format(n=1)}) UNION ALL SELECT 2, * FROM ({_NTH.format(n=2)})", "trips")
def w5(spark, sf):
    trips = trips_of(spark, sf).select("op_date", "card_id", "txn_id", "board_ts")
    parts = [nth_trip(trips, n).select(F.lit(n).alias("n"), "*") for n in (1, 2)]
    return parts[0].unionByName(parts[1])


cte(
    "two_trips",
    """
SELECT *, row_number() OVER (PARTITION BY op_date, card_id ORDER BY board_ts, txn_id) AS trip_no FROM trips
QUALIFY count(*) OVER (PARTITION BY op_date, card_id) = 2
""",
    "trips",
)


@query("q_w5_cards_with", "SELECT op_date, card_id, txn_id, board_ts, CAST(trip_no AS INTEGER) AS trip_no FROM two_trips", "two_trips")
def w5_cards(spark, sf):
    trips = trips_of(spark, sf).select("op_date", "card_id", "txn_id", "board_ts")
    return cards_with(trips, 2, ["op_date", "card_id"])


cte(
    "return_gaps",
    """
SELECT a.op_date, a.card_id, round(sqrt((s.x_5179 - d.x_5179) * (s.x_5179 - d.x_5179)
  + (s.y_5179 - d.y_5179) * (s.y_5179 - d.y_5179)), 2) AS distance
FROM two_trips a JOIN two_trips b ON a.op_date = b.op_date AND a.card_id = b.card_id AND a.trip_no = 1 AND b.trip_no = 2
LEFT JOIN stops s ON a.alight_stop = s.stop_id AND a.alight_region = s.region_code AND a.alight_mode = s.mode
LEFT JOIN stops d ON b.board_stop = d.stop_id AND b.board_region = d.region_code AND b.board_mode = d.mode
""",
    "two_trips",
    "stops",
)


@query("q_w6_return_gap", "SELECT * FROM return_gaps", "return_gaps")
def w6(spark, sf):
    located = enrich.enrich_stops(trips_of(spark, sf), clean_stops(spark, sf), ["x_5179", "y_5179"])
    return catchment.return_gap(located, ["op_date", "card_id"])


CATCHMENT_METRES = 2500.0
cte(
    "near_stops",
    f"""
SELECT DISTINCT s.stop_id FROM stops s JOIN centres c
  ON (s.x_5179 - c.cx) * (s.x_5179 - c.cx) + (s.y_5179 - c.cy) * (s.y_5179 - c.cy)
     <= {CATCHMENT_METRES} * {CATCHMENT_METRES}
""",
    "stops",
    "centres",
)
cte(
    "round_commuters",
    """
SELECT a.op_date, a.card_id FROM two_trips a JOIN two_trips b
 ON a.op_date = b.op_date AND a.card_id = b.card_id AND a.trip_no = 1 AND b.trip_no = 2
WHERE a.board_stop IN (SELECT stop_id FROM near_stops) AND b.alight_stop IN (SELECT stop_id FROM near_stops)
 AND CAST(a.alight_ts AS TIME) BETWEEN TIME '07:00:00' AND TIME '10:00:00'
 AND CAST(b.board_ts AS TIME) BETWEEN TIME '17:00:00' AND TIME '20:00:00'
""",
    "two_trips",
    "near_stops",
)


@query(
    "q_w7_round_trip_commuters",
    """
SELECT t.op_date, t.card_id, t.txn_id, t.board_stop, t.alight_stop, CAST(t.trip_no AS INTEGER) AS trip_no
FROM two_trips t JOIN round_commuters c ON t.op_date = c.op_date AND t.card_id = c.card_id
""",
    "two_trips",
    "round_commuters",
)
def w7(spark, sf):
    stops = clean_stops(spark, sf)
    near = spatial.within_radius(stops, district_centres(stops), CATCHMENT_METRES)
    trips = trips_of(spark, sf).select(
        "op_date", "card_id", "txn_id", "board_stop", "alight_stop", "board_ts", "alight_ts"
    )
    return catchment.round_trip_commuters(trips, near, ["op_date", "card_id"]).drop("board_ts", "alight_ts")
