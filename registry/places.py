"""G: coordinates, grid cells, home and work stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapflow.functions.geo import LOCAL_FROM, LOCAL_TO, local_grid
from tapflow.operators import anchors as anchor_ops
from tapflow.operators import clean, history, spatial
from tapflow.plans import jobs

from .aggregates import anchored, clean_stops, trips_of
from .catalog import query, rounded
from .standin import cte, holidays, metres_sql, cell_sql, raw_stops, stop_snapshots, taps


@query(
    "q_g1_build_stops",
    """
SELECT stop_id, region_code, mode, stop_name, xy_suspect, round(x_5179, 2) AS x_5179, round(y_5179, 2) AS y_5179, grid_id
FROM stops
""",
    "stops",
)
def g1(spark, sf):
    return rounded(clean_stops(spark, sf), "x_5179", "y_5179", digits=2).select(
        "stop_id", "region_code", "mode", "stop_name", "xy_suspect", "x_5179", "y_5179", "grid_id"
    )


_CHANGED = "(stop_id % 3 = 0 OR stop_id % 4 = 0 AND raw_x < 1000)"


cte(
    "stop_spans",
    f"""
SELECT stop_id, mode, span[1] AS valid_from, span[2] AS valid_to FROM (
 SELECT stop_id, mode, unnest(CASE WHEN stop_id % 50 = 7 THEN [['202312', '202402'], ['202403', '999999']]
  WHEN {_CHANGED} THEN [['202312', '202402'], ['202402', '999999']] ELSE [['202312', '999999']] END) AS span
 FROM (SELECT *, gps_x AS raw_x FROM raw_stops))
""",
    "raw_stops",
)


@query(
    "q_g1_stop_history",
    f"""
SELECT stop_id, region_code, mode, stop_name, xy_suspect, round(CASE WHEN xy_suspect = 0 THEN x_5179 END, 2) AS x_5179,
  round(CASE WHEN xy_suspect = 0 THEN y_5179 END, 2) AS y_5179, valid_from, valid_to,
  CASE WHEN xy_suspect = 0 THEN {cell_sql("x_5179", "y_5179")} END AS grid_id
FROM ({metres_sql('''SELECT stop_id, region_code, mode, stop_name, valid_from, valid_to, CASE WHEN gps_y > 100 AND gps_x < 100 THEN gps_y ELSE gps_x END AS gps_x,
  CASE WHEN gps_y > 100 AND gps_x < 100 THEN gps_x ELSE gps_y END AS gps_y, CAST((gps_y > 100) <> (gps_x < 100) AS INTEGER) AS xy_suspect
 FROM (SELECT s.*, v.valid_from, v.valid_to FROM stop_spans v JOIN stop_snapshots s ON s.ym = v.valid_from AND s.stop_id = v.stop_id AND s.mode = v.mode)
 WHERE gps_x < 1000 AND gps_y < 1000''', "gps_x", "gps_y")})
""",
    "stop_spans",
    "stop_snapshots",
)
def g1_history(spark, sf):
    """Versions of the stops; the SQL states which stops change when."""
    return rounded(history.stop_history(stop_snapshots(spark, sf)), "x_5179", "y_5179", digits=2).select(
        "stop_id", "region_code", "mode", "stop_name", "xy_suspect", "x_5179", "y_5179", "valid_from", "valid_to", "grid_id"
    )


def wkt_sql(cell: str) -> str:
    """Letters to 100 km steps, digits to metres."""
    x, y = f"instr('ABCDEFG', substr({cell}, 1, 1))", f"instr('BCDEFGH', substr({cell}, 2, 1))"
    return f"""
CASE WHEN length({cell}) >= 12 AND {x} > 0 AND {y} > 0 AND regexp_full_match(substr({cell}, 3), '[0-9]+') THEN
  'POINT (' || (({x} + 6) * 100000 + CAST(substr({cell}, 3, 5) AS BIGINT)) || ' '
  || (({y} + 13) * 100000 + CAST(substr({cell}, 8) AS BIGINT)) || ')' END
"""


def monthly_od(spark, sf):
    return jobs.monthly_commute_od(taps(spark, sf), raw_stops(spark, sf), holidays(spark))


@query(
    "q_g2_grid_od",
    """
SELECT board_grid, alight_grid, trip_type, CAST(sum(trips) AS BIGINT) AS trips, count(*) AS od_pairs
FROM od_grid GROUP BY 1, 2, 3
""",
    "od_grid",
)
def g2(spark, sf):
    return spatial.grid_od(monthly_od(spark, sf))


cte(
    "cells",
    """
SELECT stop_id, mode, CASE stop_id % 10 WHEN 1 THEN left(grid_id, 11) WHEN 2 THEN 'Z' || substr(grid_id, 2)
  WHEN 3 THEN left(grid_id, 5) || 'x' || substr(grid_id, 7) WHEN 4 THEN NULL ELSE grid_id END AS board_grid,
  grid_id AS alight_grid FROM stops
""",
    "stops",
)


def spoiled_cells(spark, sf):
    """Cells with faults: too short, an unknown letter, a letter among digits, NULL."""
    g, k = F.col("grid_id"), F.col("stop_id") % 10
    return clean_stops(spark, sf).select(
        "stop_id",
        "mode",
        F.when(k == 1, F.substring(g, 1, 11))
        .when(k == 2, F.concat(F.lit("Z"), F.substring(g, 2, 20)))
        .when(k == 3, F.concat(F.substring(g, 1, 5), F.lit("x"), F.substring(g, 7, 20)))
        .when(k == 4, None)
        .otherwise(g)
        .alias("board_grid"),
        g.alias("alight_grid"),
    )


@query(
    "q_g3_decode_grid_od",
    f"SELECT *, {wkt_sql('board_grid')} AS board_wkt, {wkt_sql('alight_grid')} AS alight_wkt FROM cells",
    "cells",
)
def g3(spark, sf):
    return spatial.decode_grid_od(spoiled_cells(spark, sf))


@query(
    "q_g4_local_grid",
    f"SELECT stop_id, mode, grid_id, translate(grid_id, '{LOCAL_FROM}', '{LOCAL_TO}') AS local_id FROM stops",
    "stops",
)
def g4(spark, sf):
    return clean_stops(spark, sf).select("stop_id", "mode", "grid_id", local_grid(F.col("grid_id")).alias("local_id"))


@query("q_g5_anchors", "SELECT * FROM anchors", "anchors")
def g5(spark, sf):
    return anchored(spark, sf)[2]


@query("q_g5_anchors_joins", "SELECT * FROM anchors", "anchors")
def g5_joins(spark, sf):
    """Every card through the joins that cards with many stops take."""
    trips, stops = jobs.staged(trips_of(spark, sf), "trips"), jobs.staged(clean_stops(spark, sf), "stops")
    return jobs.find_anchors(trips, stops, holidays(spark), small_card=0)


@query("q_g6_all_anchors", "SELECT * FROM anchors", "anchors")
def g6(spark, sf):
    """From candidate rows, each window clustered on its own, then merged and
    written once."""
    trips = jobs.staged(trips_of(spark, sf), "trips")
    stops = jobs.staged(clean_stops(spark, sf), "stops")
    off = holidays(spark)
    cols = ("stop_name", "y_5179", "x_5179")
    windows = {
        kind: anchor_ops.candidate_stops(trips, stops, off, kind, cols)
        .withColumn("location_type", F.lit(kind))
        .withColumnsRenamed({"x_5179": "x", "y_5179": "y"})
        for kind in ("residence", "office")
    }
    cards = anchor_ops.valid_cards(windows["residence"], windows["office"])
    parts = [anchor_ops.anchors(clean.keep_cards(rows, cards)) for rows in windows.values()]
    return jobs.staged(anchor_ops.all_anchors(*parts), "anchors")


@query(
    "q_g7_obstacle_cells",
    """
SELECT stop_id, region_code, format('POLYGON (({0:.6f} {1:.6f}, {0:.6f} {3:.6f}, {2:.6f} {3:.6f}, {2:.6f} {1:.6f}, {0:.6f} {1:.6f}))',
  gps_x - 0.003, gps_y - 0.003, gps_x + 0.003, gps_y + 0.003) AS cell_wkt
FROM stops WHERE mode = 'T' AND p_type = 'ECONOMY' AND region_code IN ('R0', 'R1')
""",
    "stops",
)
def g7(spark, sf):
    around = clean_stops(spark, sf).where(F.col("mode") == "T")
    step = F.lit(0.003)
    cells = around.select(
        "stop_id",
        "region_code",
        F.when(F.col("p_type") == "ECONOMY", "1").otherwise("0").alias("obstacle_yn"),
        (F.col("gps_x") - step).alias("lon_min"),
        (F.col("gps_y") - step).alias("lat_min"),
        (F.col("gps_x") + step).alias("lon_max"),
        (F.col("gps_y") + step).alias("lat_max"),
    )
    return spatial.obstacle_cells(cells, ["R0", "R1"]).select("stop_id", "region_code", "cell_wkt")
