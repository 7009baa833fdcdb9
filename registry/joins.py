"""J: joins. U: set operations. L: order, limit, sample."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapflow.functions.geo import GRID_X_LETTERS, GRID_Y_LETTERS, LOCAL_FROM, LOCAL_TO

from tapflow.functions.times import year_month
from tapflow.operators import clean, enrich, history, ordering, quality, spatial
from tapflow.operators.trips import purpose_trips, purpose_trips_by_leg

from .catalog import query
from .standin import cte, month_taps, raw_stops, stop_snapshots, table, taps

TRIP_COLUMNS = """op_date, card_id, txn_id, board_stop, alight_stop, board_ts, alight_ts, board_region, alight_region,
  board_mode, alight_mode, total_distance, total_ride_sec"""


@query(
    "q_j1_enrich_stops",
    """
SELECT t.op_date, t.card_id, t.txn_id, t.board_stop, t.alight_stop, b.stop_name AS board_stop_name,
  b.gps_x AS board_gps_x, a.stop_name AS alight_stop_name, a.gps_x AS alight_gps_x FROM trips t
LEFT JOIN raw_stops b ON t.board_stop = b.stop_id AND t.board_region = b.region_code AND t.board_mode = b.mode
LEFT JOIN raw_stops a ON t.alight_stop = a.stop_id AND t.alight_region = a.region_code AND t.alight_mode = a.mode
""",
    "trips",
    "raw_stops",
)
def j1(spark, sf):
    trips = purpose_trips(taps(spark, sf))
    named = enrich.enrich_stops(trips, raw_stops(spark, sf), ["stop_name", "gps_x"])
    return named.select(
        "op_date", "card_id", "txn_id", "board_stop", "alight_stop",
        "board_stop_name", "board_gps_x", "alight_stop_name", "alight_gps_x",
    )


@query(
    "q_j1_enrich_stops_of_month",
    """
SELECT t.op_date, t.card_id, t.txn_id, t.event_id, b.stop_name AS board_stop_name, b.gps_x AS board_gps_x, a.stop_name AS alight_stop_name, a.gps_x AS alight_gps_x
FROM (SELECT *, strftime(op_date, '%Y%m') AS ym, CASE WHEN mode_code BETWEEN 200 AND 299 THEN 'T' ELSE 'B' END AS mode FROM month_taps) t
LEFT JOIN month_stops b ON t.ym = b.ym AND t.board_stop = b.stop_id AND t.region_code = b.region_code AND t.mode = b.mode
LEFT JOIN month_stops a ON t.ym = a.ym AND t.alight_stop = a.stop_id AND t.region_code = a.region_code AND t.mode = a.mode
""",
    "month_taps",
    "month_stops",
)
def j1_month(spark, sf):
    legs = clean.with_mode(month_taps(spark, sf), "mode_code").withColumn("ym", year_month(F.col("op_date")))
    ends = legs.withColumns({f"{side}_{c}": F.col(of) for side in ("board", "alight") for c, of in (("region", "region_code"), ("mode", "mode"))})
    held = history.versions(stop_snapshots(spark, sf), ["stop_id", "region_code", "mode"])
    named = enrich.enrich_stops(ends, held, ["stop_name", "gps_x"], month="ym")
    return named.select("op_date", "card_id", "txn_id", "event_id", "board_stop_name", "board_gps_x", "alight_stop_name", "alight_gps_x")


@query(
    "q_j4_canonicalise_stops",
    """
SELECT t.op_date, t.card_id, t.txn_id, coalesce(b.canonical_stop_id, CAST(t.board_stop AS VARCHAR)) AS board_stop,
  coalesce(a.canonical_stop_id, CAST(t.alight_stop AS VARCHAR)) AS alight_stop FROM trips t
LEFT JOIN transfer_map b ON CAST(t.board_stop AS VARCHAR) = b.stop_id AND t.board_region = b.region_code
 AND t.board_mode = b.mode
LEFT JOIN transfer_map a ON CAST(t.alight_stop AS VARCHAR) = a.stop_id AND t.alight_region = a.region_code
 AND t.alight_mode = a.mode
""",
    "trips",
    "transfer_map",
)
def j4(spark, sf):
    mapping = enrich.transfer_map_from_names(clean.build_stops(raw_stops(spark, sf)))
    merged = enrich.canonicalise_stops(purpose_trips(taps(spark, sf)), mapping)
    return merged.select("op_date", "card_id", "txn_id", "board_stop", "alight_stop")


@query("q_j5_purpose_trips_by_leg", f"SELECT {TRIP_COLUMNS} FROM leg_trips", "leg_trips")
def j5(spark, sf):
    return purpose_trips_by_leg(taps(spark, sf))



@query(
    "q_j7_join_audit",
    """
SELECT *, round_even(matched / rows * 100.0, 2) AS matched_pct, round_even(unmatched / rows * 100.0, 2) AS unmatched_pct,
  round_even(unmatched_ids / ids * 100.0, 2) AS unmatched_ids_pct
FROM (SELECT count(*) AS rows, count(s.stop_id) AS matched, count(*) - count(s.stop_id) AS unmatched,
  count(DISTINCT m.board_stop) AS ids, count(DISTINCT m.board_stop) FILTER (WHERE s.stop_id IS NULL) AS unmatched_ids
FROM modes m LEFT JOIN raw_stops s ON m.board_stop = s.stop_id AND m.region_code = s.region_code AND m.mode = s.mode)
""",
    "modes",
    "raw_stops",
)
def j7(spark, sf):
    moded = clean.with_mode(taps(spark, sf), "mode_code")
    return enrich.join_audit(
        moded,
        raw_stops(spark, sf),
        {"board_stop": "stop_id", "region_code": "region_code", "mode": "mode"},
        "board_stop",
    )


@query(
    "q_j7_unmatched_rows",
    """
SELECT m.event_id, m.alight_stop, m.region_code FROM modes m LEFT JOIN raw_stops s
ON m.alight_stop = s.stop_id AND m.region_code = s.region_code AND m.mode = s.mode WHERE s.stop_id IS NULL
""",
    "modes",
    "raw_stops",
)
def j7_rows(spark, sf):
    moded = clean.with_mode(taps(spark, sf), "mode_code")
    key = {"alight_stop": "stop_id", "region_code": "region_code", "mode": "mode"}
    return enrich.unmatched_rows(moded, raw_stops(spark, sf), key).select("event_id", "alight_stop", "region_code")


_AUDIT_BY = """
SELECT {g} AS grp, count(*) AS rows, count(s.stop_id) AS matched, count(*) - count(s.stop_id) AS unmatched,
  count(DISTINCT m.alight_stop) AS ids, count(DISTINCT m.alight_stop) FILTER (WHERE s.stop_id IS NULL) AS unmatched_ids
FROM modes m LEFT JOIN raw_stops s ON m.alight_stop = s.stop_id AND m.region_code = s.region_code AND m.mode = s.mode
GROUP BY 1
"""


@query(
    "q_j8_join_audit_by",
    f"""
SELECT *, round_even(matched / rows * 100.0, 2) AS matched_pct, round_even(unmatched / rows * 100.0, 2) AS unmatched_pct,
  round_even(unmatched_ids / ids * 100.0, 2) AS unmatched_ids_pct
FROM ({_AUDIT_BY.format(g="m.operator_id")} UNION ALL {_AUDIT_BY.format(g="'total'")})
""",
    "modes",
    "raw_stops",
)
def j8(spark, sf):
    moded = clean.with_mode(taps(spark, sf), "mode_code")
    return enrich.join_audit_by(
        moded,
        raw_stops(spark, sf),
        {"alight_stop": "stop_id", "region_code": "region_code", "mode": "mode"},
        "alight_stop",
        "operator_id",
    )


_LETTERS = ", ".join(
    f"('{x}{y}', '{LOCAL_TO[LOCAL_FROM.index(x)]}{LOCAL_TO[LOCAL_FROM.index(y)]}')"
    for x in GRID_X_LETTERS
    for y in GRID_Y_LETTERS
)


@query(
    "q_j11_relabel_grid",
    f"""
SELECT s.stop_id, s.mode, coalesce(l.local || substr(s.grid_id, 3), s.grid_id) AS grid_id
FROM stops s LEFT JOIN (VALUES {_LETTERS}) l(alphabet, local) ON left(s.grid_id, 2) = l.alphabet
""",
    "stops",
)
def j11(spark, sf):
    pairs = [(x + y, x + y) for x in GRID_X_LETTERS for y in GRID_Y_LETTERS]
    letters = spark.createDataFrame(pairs, "alphabet string, raw string").select(
        "alphabet", F.translate("raw", LOCAL_FROM, LOCAL_TO).alias("local")
    )
    stops = clean.build_stops(raw_stops(spark, sf)).select("stop_id", "mode", "grid_id")
    return enrich.relabel_grid(stops, letters, ["grid_id"])


# --- spatial joins -----------------------------------------------------------------------------

cte(
    "centres",
    """
SELECT legal_dong AS centre_id, round(avg(x_5179), 3) AS cx, round(avg(y_5179), 3) AS cy
FROM stops WHERE mode = 'T' AND x_5179 IS NOT NULL GROUP BY 1
""",
    "stops",
)


def district_centres(stops):
    located = stops.where((F.col("mode") == "T") & F.col("x_5179").isNotNull())
    middle = spatial.group_centroid(located, ["legal_dong"], "x_5179", "y_5179", [], "stop_id")
    return middle.select(
        F.col("legal_dong").alias("centre_id"),
        F.round("centre_x", 3).alias("x_5179"),
        F.round("centre_y", 3).alias("y_5179"),
    )


@query(
    "q_j13_within_radius",
    """
SELECT s.stop_id, s.mode, c.centre_id,
  round(sqrt((s.x_5179 - c.cx) * (s.x_5179 - c.cx) + (s.y_5179 - c.cy) * (s.y_5179 - c.cy)), 2) AS distance_m
FROM stops s JOIN centres c
  ON (s.x_5179 - c.cx) * (s.x_5179 - c.cx) + (s.y_5179 - c.cy) * (s.y_5179 - c.cy) <= 700.0 * 700.0
""",
    "stops",
    "centres",
)
def j13(spark, sf):
    stops = clean.build_stops(raw_stops(spark, sf))
    near = spatial.within_radius(stops, district_centres(stops), 700.0)
    return near.select("stop_id", "mode", "centre_id", F.round("distance_m", 2).alias("distance_m"))


cte(
    "sites",
    """
SELECT min(stop_id) AS site_id, avg(x_5179) AS sx, avg(y_5179) AS sy FROM stops
WHERE mode = 'T' AND x_5179 IS NOT NULL GROUP BY region_code, stop_name
""",
    "stops",
)
_AWAY = "sqrt((s.x_5179 - c.sx) * (s.x_5179 - c.sx) + (s.y_5179 - c.sy) * (s.y_5179 - c.sy))"
cte(
    "site_pairs",
    f"""
SELECT s.stop_id, s.region_code, s.mode, arg_min(c.site_id, ({_AWAY}, c.site_id)) AS site, min({_AWAY}) AS away
FROM stops s, sites c WHERE s.x_5179 IS NOT NULL GROUP BY ALL
""",
    "stops",
    "sites",
)
cte(
    "station_cells",
    """
SELECT s.* EXCLUDE (cell_id), p.site AS cell_id, p.away AS site_distance FROM stops s
LEFT JOIN site_pairs p ON s.stop_id = p.stop_id AND s.region_code = p.region_code AND s.mode = p.mode
""",
    "stops",
    "site_pairs",
)


def station_sites(stops):
    subway = stops.where((F.col("mode") == "T") & F.col("x_5179").isNotNull())
    middle = spatial.group_centroid(
        subway, ["region_code", "stop_name"], "x_5179", "y_5179", ["stop_id"], "stop_id"
    )
    return middle.select(
        F.col("stop_id").alias("site_id"), F.col("centre_x").alias("x_5179"), F.col("centre_y").alias("y_5179")
    )


@query(
    "q_j14_nearest_site",
    "SELECT stop_id, mode, cell_id AS nearest_site, round(site_distance, 2) AS site_distance FROM station_cells",
    "station_cells",
)
def j14(spark, sf):
    stops = clean.build_stops(raw_stops(spark, sf)).drop("cell_id")
    near = spatial.nearest_site(stops, station_sites(stops), key=["stop_id", "region_code", "mode"])
    return near.select("stop_id", "mode", "nearest_site", F.round("site_distance", 2).alias("site_distance"))


@query(
    "q_j14_nearest_site_bounded",
    """
SELECT stop_id, mode, CASE WHEN site_distance <= 400 THEN cell_id END AS nearest_site,
  CASE WHEN site_distance <= 400 THEN round(site_distance, 2) END AS site_distance FROM station_cells
""",
    "station_cells",
)
def j14_bounded(spark, sf):
    stops = clean.build_stops(raw_stops(spark, sf)).drop("cell_id")
    near = spatial.nearest_site(stops, station_sites(stops), 400.0, key=["stop_id", "region_code", "mode"])
    return near.select("stop_id", "mode", "nearest_site", F.round("site_distance", 2).alias("site_distance"))


# --- set operations ----------------------------------------------------------------------------


@query(
    "q_u3_key_diff",
    """
SELECT (SELECT count(DISTINCT board_stop) FROM taps) AS a_keys, (SELECT count(DISTINCT stop_id) FROM raw_stops) AS b_keys,
  (SELECT count(*) FROM (SELECT board_stop FROM taps WHERE board_stop IS NOT NULL EXCEPT SELECT stop_id FROM raw_stops))
    AS only_a,
  (SELECT count(*) FROM (SELECT stop_id FROM raw_stops EXCEPT SELECT board_stop FROM taps)) AS only_b
""",
    "taps",
    "raw_stops",
)
def u3(spark, sf):
    return quality.key_diff(taps(spark, sf), raw_stops(spark, sf), "board_stop", "stop_id")


@query(
    "q_u3_rows_without",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)",
)
def u3_rows(spark, sf):
    bulk = table(spark, sf, "lineitem").where(F.col("l_quantity") >= 50)
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return quality.rows_without(parts, bulk, "p_partkey", "l_partkey")


@query(
    "q_u5_dedup",
    """
SELECT event_id, card_id, board_stop, board_ts FROM taps
QUALIFY row_number() OVER (PARTITION BY card_id, board_stop ORDER BY board_ts, event_id) = 1
""",
    "taps",
)
def u5(spark, sf):
    return ordering.dedup(
        taps(spark, sf).select("event_id", "card_id", "board_stop", "board_ts"),
        ["card_id", "board_stop"],
        ["board_ts", "event_id"],
    )


@query("q_l2_head", "SELECT event_id, card_id, board_ts FROM taps ORDER BY board_ts DESC, event_id DESC LIMIT 100", "taps")
def l2(spark, sf):
    df = taps(spark, sf).select("event_id", "card_id", "board_ts")
    return ordering.head(df, [F.col("board_ts").desc(), F.col("event_id").desc()], 100)


@query(
    "q_l3_sample_cards",
    """
SELECT event_id, card_id FROM taps WHERE card_id IN (SELECT card_id FROM (SELECT DISTINCT card_id FROM taps)
  ORDER BY md5(card_id || ':42'), card_id LIMIT 10)
""",
    "taps",
)
def l3(spark, sf):
    return ordering.sample_cards(taps(spark, sf).select("event_id", "card_id"), 10, 42)


@query(
    "q_l4_sample_rows",
    """
SELECT event_id, card_id, distance FROM taps
WHERE CAST('0x' || substr(md5(concat(event_id, ':42')), 1, 8) AS BIGINT) < CAST(floor(0.1 * 4294967296) AS BIGINT)
""",
    "taps",
)
def l4(spark, sf):
    return ordering.sample_rows(taps(spark, sf).select("event_id", "card_id", "distance"), 0.1, 42, ["event_id"])
