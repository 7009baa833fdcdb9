"""A: aggregations, with the joins that exist only to feed them (J2, J6, J12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapflow.functions.times import year_month
from tapflow.operators import anchors as anchor_ops
from tapflow.operators import clean, enrich, od, quality, spatial
from tapflow.operators.calendar import business_day_counts, month_span
from tapflow.operators.trips import purpose_trips, purpose_trips_by_leg
from tapflow.plans import jobs

from .catalog import query, rounded
from .joins import TRIP_COLUMNS
from .standin import cte, holidays, raw_stops, table, taps


def trips_of(spark, sf):
    return purpose_trips(taps(spark, sf))


def clean_stops(spark, sf):
    return clean.build_stops(raw_stops(spark, sf))


@query("q_a1_purpose_trips", f"SELECT {TRIP_COLUMNS}, max_transfers FROM trips", "trips")
def a1(spark, sf):
    return trips_of(spark, sf)


@query(
    "q_a1_order_trips",
    """
SELECT l_orderkey, l_shipdate,
  arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax)) AS first_part,
  arg_max(l_suppkey, (l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax)) AS last_supp,
  round(sum(l_extendedprice), 2) AS total, max(l_linenumber) AS max_transfers
FROM lineitem GROUP BY ALL
""",
)
def a1_volume(spark, sf):
    """The roll-up on the largest table: order lines as legs."""
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax")
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_shipdate")
        .agg(
            F.min_by("l_partkey", order).alias("first_part"),
            F.max_by("l_suppkey", order).alias("last_supp"),
            F.round(F.sum("l_extendedprice"), 2).alias("total"),
            F.max("l_linenumber").alias("max_transfers"),
        )
    )


@query(
    "q_a2_purpose_trips_extra",
    """
SELECT op_date, card_id, txn_id, min(board_ts) AS board_ts, max(alight_ts) AS alight_ts,
  sum(distance) AS total_distance, max(transfer_no) AS max_transfers,
  arg_min(operator_id, (board_ts, transfer_no)) AS operator_id,
  arg_min(user_type, (board_ts, transfer_no)) AS user_type,
  arg_min(route_id, (board_ts, transfer_no)) AS board_route,
  arg_max(route_id, (alight_ts, transfer_no)) FILTER (WHERE alight_ts IS NOT NULL) AS alight_route
FROM taps GROUP BY op_date, card_id, txn_id HAVING min(board_ts) IS NOT NULL AND max(alight_ts) IS NOT NULL
""",
    "taps",
)
def a2(spark, sf):
    extra = {
        "operator_id": "first:operator_id",
        "user_type": "first:user_type",
        "board_route": "first:route_id",
        "alight_route": "last:route_id",
    }
    return purpose_trips(taps(spark, sf), adults_only=False, extra=extra).select(
        "op_date", "card_id", "txn_id", "board_ts", "alight_ts", "total_distance", "max_transfers", *extra
    )


@query("q_a3_valid_cards", "SELECT card_id FROM valid_cards", "valid_cards")
def a3(spark, sf):
    return anchor_ops.enough_rows(anchor_ops.window_rows(trips_of(spark, sf), holidays(spark)))


@query(
    "q_a4_candidate_stops",
    """
SELECT op_date, card_id, stop_id, hour, type, region_code, mode, stop_name, gps_y, gps_x, location_type
FROM (SELECT * FROM residence UNION ALL SELECT * FROM office)
""",
    "residence",
    "office",
)
def a4(spark, sf):
    return anchor_ops.candidates(trips_of(spark, sf), clean_stops(spark, sf), holidays(spark)).drop("event_ts")


OD_ROUNDED = ("distance_avg", "distance_median", "time_avg", "time_median")


def anchored(spark, sf):
    """Trips, clean stops and anchors, each read several times."""
    trips, stops = jobs.staged(trips_of(spark, sf), "trips"), jobs.staged(clean_stops(spark, sf), "stops")
    return trips, stops, jobs.staged(jobs.find_anchors(trips, stops, holidays(spark)), "anchors")


@query(
    "q_j2_match_commutes",
    f"SELECT {TRIP_COLUMNS}, max_transfers, trip_type FROM matched",
    "matched",
)
def j2(spark, sf):
    trips, _, found = anchored(spark, sf)
    return od.match_commutes(trips, found)


@query("q_a5_commute_od", "SELECT * EXCLUDE (ym) FROM od", "od")
def a5(spark, sf):
    """All sf data lies in one month, so the monthly and the plain table agree."""
    trips, stops, found = anchored(spark, sf)
    mapping = enrich.transfer_map_from_names(stops)
    return rounded(od.commute_od(trips, found, mapping, holidays(spark)), *OD_ROUNDED)


@query(
    "q_a6_od_monitor",
    """
SELECT strftime(op_date, '%Y%m') AS ym, trip_type, count(*) AS monthly_od_cnt,
  count(DISTINCT card_id) AS monthly_od_card_cnt FROM matched GROUP BY 1, 2
""",
    "matched",
)
def a6(spark, sf):
    trips, _, found = anchored(spark, sf)
    matched = od.match_commutes(trips, found)
    return od.od_monitor(matched.withColumn("ym", year_month(F.col("op_date"))), ("ym", "trip_type"))


# --- modal cells --------------------------------------------------------------------------------

cte(
    "tagged",
    """
SELECT t.*, b.cell_id AS board_cell, a.cell_id AS alight_cell, b.stop_name AS board_name, a.stop_name AS alight_name,
  b.legal_dong AS board_dong, a.legal_dong AS alight_dong, b.gps_x AS board_x, b.gps_y AS board_y,
  a.gps_x AS alight_x, a.gps_y AS alight_y
FROM leg_trips t
LEFT JOIN raw_stops b ON t.board_stop = b.stop_id AND t.board_region = b.region_code AND t.board_mode = b.mode
LEFT JOIN raw_stops a ON t.alight_stop = a.stop_id AND t.alight_region = a.region_code AND t.alight_mode = a.mode
""",
    "leg_trips",
    "raw_stops",
)
_WINDOWS = {
    "am_dep": ("board", 6, 12),
    "pm_arr": ("alight", 16, 24),
    "am_arr": ("alight", 6, 12),
    "pm_dep": ("board", 16, 24),
}


def modal_views(source: str, prefix: str = "") -> None:
    """Most frequent cells of a card in each window; anchors are the smallest cells that both windows of an anchor share."""
    ends = " UNION ALL ".join(
        f"SELECT '{name}' AS win, card_id, {end}_cell AS cell FROM {source} WHERE hour({end}_ts) BETWEEN {lo} AND {hi}"
        for name, (end, lo, hi) in _WINDOWS.items()
    )
    cte(
        f"{prefix}window_modes",
        f"""
SELECT win, card_id, cell, freq FROM (
  SELECT win, card_id, cell, count(*) AS freq, rank() OVER (PARTITION BY win, card_id ORDER BY count(*) DESC) AS place
  FROM ({ends}) GROUP BY win, card_id, cell)
WHERE place = 1
""",
        source,
    )
    cte(
        f"{prefix}anchor_cells",
        f"""
WITH shared AS (
  SELECT card_id, anchor, cell FROM {prefix}window_modes
  JOIN (VALUES ('am_dep', 'home'), ('pm_arr', 'home'), ('am_arr', 'work'), ('pm_dep', 'work')) k(win, anchor) USING (win)
  WHERE cell IS NOT NULL GROUP BY card_id, anchor, cell HAVING count(*) = 2)
SELECT card_id, min(cell) FILTER (anchor = 'home') AS home_cell, min(cell) FILTER (anchor = 'work') AS work_cell
FROM shared GROUP BY card_id HAVING count(DISTINCT anchor) = 2
""",
        f"{prefix}window_modes",
    )


modal_views("tagged")


def leg_trips_of(spark, sf):
    return purpose_trips_by_leg(taps(spark, sf))


def cell_stops(spark, sf):
    return raw_stops(spark, sf)


@query(
    "q_a7_modal_cell",
    "SELECT card_id, win, cell, freq FROM window_modes",
    "window_modes",
)
def a7(spark, sf):
    tagged = anchor_ops.with_cells(leg_trips_of(spark, sf), cell_stops(spark, sf))
    return anchor_ops.modal_cells(tagged)


@query("q_a7_modal_cell_one_window", "SELECT card_id, cell AS am_dep, freq FROM window_modes WHERE win = 'am_dep'", "window_modes")
def a7_one(spark, sf):
    tagged = anchor_ops.with_cells(leg_trips_of(spark, sf), cell_stops(spark, sf))
    return anchor_ops.modal_cell(tagged, "card_id", "board_cell", "board_ts", (6, 12), "am_dep")


@query("q_a8_anchor_cells", "SELECT * FROM anchor_cells", "anchor_cells")
def a8(spark, sf):
    return anchor_ops.anchor_cells(leg_trips_of(spark, sf), cell_stops(spark, sf))


@query(
    "q_j12_commuter_trips",
    """
SELECT t.op_date, t.card_id, t.txn_id, t.board_stop, t.alight_stop, c.home_cell, c.work_cell
FROM leg_trips t JOIN anchor_cells c ON t.card_id = c.card_id
""",
    "leg_trips",
    "anchor_cells",
)
def j12(spark, sf):
    trips, stops = leg_trips_of(spark, sf), cell_stops(spark, sf)
    return enrich.commuter_trips(trips, anchor_ops.anchor_cells(trips, stops)).select(
        "op_date", "card_id", "txn_id", "board_stop", "alight_stop", "home_cell", "work_cell"
    )


def cell_od_sql(source: str = "tagged", cells: str = "anchor_cells") -> str:
    def one(way: str, live: str, work: str) -> str:
        names = ", ".join(
            f"t.{end}_{col} AS {role}_station_{name}"
            for role, end in (("live", live), ("work", work))
            for col, name in (("stop", "id"), ("name", "name"), ("mode", "type"), ("dong", "admin"), ("x", "x"), ("y", "y"))
        )
        return f"""SELECT '{way}' AS direction, {names}, count(*) AS commute_count,
  round(avg(total_distance), 6) AS distance_avg, median(total_distance) AS distance_median,
  round(avg(total_ride_sec), 6) AS time_avg, median(total_ride_sec) AS time_median
FROM {source} t JOIN {cells} c ON t.card_id = c.card_id AND t.{live}_cell = c.home_cell AND t.{work}_cell = c.work_cell
GROUP BY ALL"""

    return one("morning", "board", "alight") + " UNION ALL " + one("evening", "alight", "board")


@query("q_a9_cell_commute_od", cell_od_sql(), "tagged", "anchor_cells")
def a9(spark, sf):
    trips, stops = leg_trips_of(spark, sf), cell_stops(spark, sf)
    cells = anchor_ops.anchor_cells(trips, stops)
    return rounded(od.cell_commutes(trips, cells, stops), "distance_avg", "time_avg")


_SIDES = ["stop", "region", "mode", "stop_name"]


def _pairs_sql(cells: str) -> str:
    def one(way: str, live: str, work: str) -> str:
        col = lambda end, c: f"t.{end}_name" if c == "stop_name" else f"t.{end}_{c}"
        names = ", ".join(
            f"{col(end, c)} AS {role}_{c}" for role, end in (("live", live), ("work", work)) for c in _SIDES
        )
        known = " AND ".join(f"{col(end, c)} IS NOT NULL" for end in ("board", "alight") for c in _SIDES)
        return f"""SELECT t.card_id, {names}, count(*) AS to_{way}_frequency,
  round(avg(total_ride_sec), 6) AS to_{way}_time, round(avg(total_distance), 6) AS to_{way}_distance
FROM tagged t JOIN {cells} c ON t.card_id = c.card_id AND t.{live}_cell = c.home_cell AND t.{work}_cell = c.work_cell
WHERE {known} GROUP BY ALL"""

    keys = ["card_id", *[f"{role}_{c}" for role in ("live", "work") for c in _SIDES]]
    return f"""
SELECT * FROM ({one("work", "board", "alight")}) w FULL JOIN ({one("live", "alight", "board")}) l
USING ({", ".join(keys)})"""


PAIR_ROUNDED = ("to_work_time", "to_work_distance", "to_live_time", "to_live_distance")


def named_cells(spark, sf):
    dim = cell_stops(spark, sf).withColumnRenamed("cell_id", "cell")
    return enrich.enrich_stops(leg_trips_of(spark, sf), dim, ["cell", "stop_name"])


@query("q_j6_pair_stats", _pairs_sql("anchor_cells"), "tagged", "anchor_cells")
def j6(spark, sf):
    cells = anchor_ops.anchor_cells(leg_trips_of(spark, sf), cell_stops(spark, sf))
    return rounded(od.pair_stats(named_cells(spark, sf), cells), *PAIR_ROUNDED)


def _lowest_mode(end: str, lo: int, hi: int) -> str:
    return f"""(SELECT card_id, arg_min(cell, (-freq, cell)) AS cell FROM (SELECT card_id, {end}_cell AS cell,
  count(*) AS freq FROM tagged WHERE hour({end}_ts) BETWEEN {lo} AND {hi} AND {end}_cell IS NOT NULL GROUP BY 1, 2)
  GROUP BY 1)"""


cte(
    "strict_cells",
    f"""
SELECT a.card_id, a.cell AS home_cell, c.cell AS work_cell FROM {_lowest_mode("board", 6, 11)} a
JOIN {_lowest_mode("alight", 16, 23)} b ON a.card_id = b.card_id AND a.cell = b.cell
JOIN {_lowest_mode("alight", 6, 11)} c ON a.card_id = c.card_id
JOIN {_lowest_mode("board", 16, 23)} d ON a.card_id = d.card_id AND c.cell = d.cell
""",
    "tagged",
)


@query("q_a10_card_commute_pairs", _pairs_sql("strict_cells"), "tagged", "strict_cells")
def a10(spark, sf):
    return rounded(od.card_commute_pairs(leg_trips_of(spark, sf), cell_stops(spark, sf)), *PAIR_ROUNDED)


@query(
    "q_a11_anchor_stats",
    """
SELECT count(*) AS total_rows, count(DISTINCT card_id) AS unique_cards,
  count(CASE WHEN location_type = 'residence' THEN 1 END) AS residence_rows,
  count(CASE WHEN location_type = 'office' THEN 1 END) AS work_rows FROM anchors
""",
    "anchors",
)
def a11(spark, sf):
    return anchor_ops.anchor_stats(anchored(spark, sf)[2])


@query(
    "q_a12_od_hourly",
    """
SELECT op_date, CAST(hour(board_ts) AS INTEGER) AS hour, board_stop, board_region, board_mode, alight_stop,
  alight_region, alight_mode, count(*) AS use_count, count(DISTINCT card_id) AS unique_use_count,
  median(total_ride_sec) AS time_median, round(avg(total_ride_sec), 6) AS time_avg,
  median(total_distance) AS distance_median, round(avg(total_distance), 6) AS distance_avg,
  median(max_transfers) AS transfer_median, round(avg(max_transfers), 6) AS transfer_avg
FROM trips GROUP BY ALL
""",
    "trips",
)
def a12(spark, sf):
    trips = jobs.staged(trips_of(spark, sf), "trips")
    return rounded(od.od_hourly(trips), "time_avg", "distance_avg", "transfer_avg")


@query(
    "q_a14_canonical_ids",
    """
SELECT region_code, mode, stop_name, min(stop_id) AS canonical_id FROM raw_stops
GROUP BY 1, 2, 3 HAVING count(DISTINCT stop_id) > 1
""",
    "raw_stops",
)
def a14(spark, sf):
    return enrich.canonical_ids(raw_stops(spark, sf), "stop_name", "stop_id", ["region_code", "mode"])


cte(
    "daily",
    """
SELECT CAST(t.alight_stop AS VARCHAR) AS alight_stop, s.stop_name AS alight_name, t.alight_mode,
  CAST(count(*) AS DOUBLE) AS daily_count
FROM trips t LEFT JOIN raw_stops s ON t.alight_stop = s.stop_id AND t.alight_region = s.region_code
 AND t.alight_mode = s.mode
WHERE t.alight_stop IS NOT NULL GROUP BY ALL
""",
    "trips",
    "raw_stops",
)


@query(
    "q_a15_top_destinations",
    """
SELECT * EXCLUDE (bar) FROM (SELECT *, quantile_cont(daily_sum, 0.97) OVER () AS bar FROM (
  SELECT coalesce(c.lowest, d.alight_stop) AS station_id, d.alight_name, d.alight_mode,
    round(sum(d.daily_count), 1) AS daily_sum
  FROM daily d LEFT JOIN (SELECT alight_name, min(alight_stop) AS lowest FROM daily WHERE alight_mode = 'T'
    GROUP BY 1 HAVING count(DISTINCT alight_stop) > 1) c ON d.alight_mode = 'T' AND d.alight_name = c.alight_name
  GROUP BY ALL)) WHERE daily_sum >= bar
""",
    "daily",
)
def a15(spark, sf):
    return od.top_destinations(daily_destinations(spark, sf))


def daily_destinations(spark, sf):
    named = enrich.enrich_stops(trips_of(spark, sf), raw_stops(spark, sf), ["stop_name"], ("alight",))
    return (
        named.where(F.col("alight_stop").isNotNull())
        .groupBy(
            F.col("alight_stop").cast("string").alias("alight_stop"),
            F.col("alight_stop_name").alias("alight_name"),
            "alight_mode",
        )
        .agg(F.count(F.lit(1)).cast("double").alias("daily_count"))
    )


# --- profiles -----------------------------------------------------------------------------------

_NULL_COLUMNS = ["event_id", "vehicle_id", "alight_stop", "alight_ts", "distance"]


@query(
    "q_a16_null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS total,
  round_even((count(*) - count({c})) / count(*) * 100.0, 2) AS null_pct FROM taps"""
        for c in _NULL_COLUMNS
    ),
    "taps",
)
def a16(spark, sf):
    return quality.null_profile(taps(spark, sf), _NULL_COLUMNS)


def _profile_sql(col: str, kind: str, source: str) -> str:
    numeric = kind in ("int", "double", "bigint")
    numbers = (
        f"""round(avg({col}), 3) AS mean, round(stddev({col}), 3) AS std, CAST(min({col}) AS DOUBLE) AS min,
  quantile_cont(CAST({col} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({col} AS DOUBLE), 0.5) AS median,
  quantile_cont(CAST({col} AS DOUBLE), 0.75) AS q3, CAST(max({col}) AS DOUBLE) AS max"""
        if numeric
        else ", ".join(f"NULL::DOUBLE AS {x}" for x in ("mean", "std", "min", "q1", "median", "q3", "max"))
    )
    counts = f"(SELECT CAST({col} AS VARCHAR) AS v, count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY 1)"
    return f"""SELECT '{col}' AS column_name, '{kind}' AS data_type, count({col}) AS total_count,
  count(DISTINCT {col}) AS unique_count, count(*) - count({col}) AS null_count,
  count(*) FILTER (WHERE CAST({col} AS VARCHAR) = '') AS blank_count,
  (SELECT arg_min(v, (-n, v)) FROM {counts}) AS top_value, (SELECT max(n) FROM {counts}) AS top_count,
  (SELECT arg_min(v, (n, v)) FROM {counts}) AS rare_value, (SELECT min(n) FROM {counts}) AS rare_count, {numbers}
FROM {source}"""


_PROFILED = {
    "vehicle_id": "string",
    "mode_code": "int",
    "board_stop": "bigint",
    "alight_stop": "bigint",
    "region_code": "string",
    "distance": "double",
    "riders": "int",
}


@query("q_a17_column_profile", " UNION ALL ".join(_profile_sql(c, k, "taps") for c, k in _PROFILED.items()), "taps")
def a17(spark, sf):
    return quality.column_profile(taps(spark, sf), list(_PROFILED))


@query(
    "q_a18_null_rate_by",
    """
SELECT mode_code, avg(CASE WHEN vehicle_id IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS ratio, count(*) AS count
FROM taps GROUP BY 1 HAVING ratio > 0
""",
    "taps",
)
def a18(spark, sf):
    return quality.null_rate_by(taps(spark, sf), "mode_code", "vehicle_id")


@query(
    "q_a19_freq_of_freq",
    "SELECT times, count(*) AS keys FROM (SELECT card_id, count(*) AS times FROM taps GROUP BY 1) GROUP BY 1",
    "taps",
)
def a19(spark, sf):
    return quality.freq_of_freq(taps(spark, sf), "card_id")


@query(
    "q_a19_weighted_mean",
    "SELECT sum(times) / count(*) AS mean_times FROM (SELECT card_id, count(*) AS times FROM taps GROUP BY 1)",
    "taps",
)
def a19_mean(spark, sf):
    return quality.weighted_mean_times(quality.freq_of_freq(taps(spark, sf), "card_id"))


@query(
    "q_a20_hourly",
    """
SELECT strftime(board_ts, '%Y%m%d%H') AS hour, CAST(sum(riders) AS BIGINT) AS users,
  round(avg(distance), 6) AS distance_avg, round(avg(ride_sec), 6) AS time_avg FROM taps GROUP BY 1
""",
    "taps",
)
def a20(spark, sf):
    return rounded(
        quality.hourly(taps(spark, sf), "board_ts", "riders", "distance", "ride_sec"), "distance_avg", "time_avg"
    )


@query(
    "q_a21_resample_counts",
    """
SELECT b.bin, coalesce(c.n, 0) AS n FROM
 (SELECT unnest(generate_series(min(bin), max(bin), INTERVAL 30 MINUTE)) AS bin FROM
   (SELECT time_bucket(INTERVAL 30 MINUTE, board_ts) AS bin FROM taps)) b
LEFT JOIN (SELECT time_bucket(INTERVAL 30 MINUTE, board_ts) AS bin, count(*) AS n FROM taps GROUP BY 1) c ON b.bin = c.bin
""",
    "taps",
)
def a21(spark, sf):
    return quality.resample_counts(taps(spark, sf), "board_ts", "30 minutes")


def bins_sql(source: str, col: str) -> str:
    edges, labels = quality.DISTANCE_EDGES, quality.DISTANCE_LABELS
    listed = ", ".join(f"({lo}, {hi}, '{label}')" for lo, hi, label in zip(edges, edges[1:], labels))
    return f"""
SELECT b.label AS bin, count(d.{col}) AS n FROM (VALUES {listed}) b(lo, hi, label)
LEFT JOIN {source} d ON d.{col} >= b.lo AND d.{col} < b.hi GROUP BY 1
UNION ALL SELECT NULL, count(*) FROM {source} d
WHERE d.{col} IS NULL OR d.{col} < {edges[0]} OR d.{col} >= {edges[-1]} HAVING count(*) > 0
"""


@query("q_a22_bin_counts", bins_sql("taps", "distance"), "taps")
def a22(spark, sf):
    return quality.bin_counts(taps(spark, sf), "distance")


_SPAN = "(SELECT op_date, card_id, min(alight_ts) AS first_alight, max(board_ts) AS last_board FROM trips GROUP BY 1, 2)"


@query(
    "q_a23_hour_crosstab",
    f"""
SELECT CAST(hour(first_alight) AS INTEGER) AS arrival_hour,
  {", ".join(f"count(*) FILTER (WHERE hour(last_board) = {h}) AS h{h:02d}" for h in range(24))}
FROM {_SPAN} GROUP BY 1
""",
    "trips",
)
def a23(spark, sf):
    return quality.hour_crosstab(trips_of(spark, sf), ["op_date", "card_id"])


@query("q_a24_day_span", f"SELECT * FROM {_SPAN}", "trips")
def a24(spark, sf):
    return quality.day_span(trips_of(spark, sf), ["op_date", "card_id"])


@query(
    "q_a26_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def a26(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q_a26_duplicate_rows",
    """
SELECT event_id, card_id, vehicle_id, op_date, count(*) OVER (PARTITION BY card_id, vehicle_id, op_date) AS copies
FROM taps QUALIFY copies > 1
""",
    "taps",
)
def a26_rows(spark, sf):
    df = taps(spark, sf).select("event_id", "card_id", "vehicle_id", "op_date")
    return quality.duplicate_rows(df, ["card_id", "vehicle_id", "op_date"])


@query(
    "q_a27_with_pk",
    """
SELECT event_id, CAST(op_date AS VARCHAR) || '_' || card_id || '_' || CAST(txn_id AS VARCHAR) || '_' || vehicle_id AS pk
FROM taps
""",
    "taps",
)
def a27(spark, sf):
    return quality.with_pk(taps(spark, sf), ["op_date", "card_id", "txn_id", "vehicle_id"]).select("event_id", "pk")


@query("q_a28_length_profile", "SELECT length(text) AS len, count(*) AS n FROM documents GROUP BY 1")
def a28(spark, sf):
    return quality.length_profile(table(spark, sf, "documents"), "text")


@query("q_a28_length_range", "SELECT min(length(card_id)) AS min_len, max(length(card_id)) AS max_len FROM taps", "taps")
def a28_range(spark, sf):
    return quality.length_range(taps(spark, sf), "card_id")


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]


@query(
    "q_a29_describe_numeric",
    "SELECT *, q1 - (q3 - q1) * 1.5::DOUBLE AS fence_low, q3 + (q3 - q1) * 1.5::DOUBLE AS fence_high FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS std,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3 FROM lineitem"""
        for c in _DESCRIBED
    )
    + ")",
)
def a29(spark, sf):
    described = rounded(
        quality.describe_numeric(table(spark, sf, "lineitem"), _DESCRIBED), "mean", "std", "q1", "median", "q3"
    )
    iqr = F.col("q3") - F.col("q1")
    return described.withColumns({"fence_low": F.col("q1") - iqr * 1.5, "fence_high": F.col("q3") + iqr * 1.5})


# The normal's share below z as the power series of its density; the statistic over single rows.
_BELOW = """list_sum(list_transform(range(0, 200), lambda k: exp((2 * k + 1) * ln(greatest(abs(z), 1e-300)) - lgamma(2 * k + 2) + k * ln(2) + lgamma(k + 1))))
  * exp(-z * z / 2) / sqrt(2 * pi())"""


@query(
    "q_a30_ks_normal",
    f"""
SELECT 'distance' AS column_name, n, round(m, 6) AS mean, round(s, 6) AS std, round(d, 6) AS statistic, round(p, 6) AS p_value, p > 0.05 AS is_normal
FROM (SELECT *, CASE WHEN t < 0.3 THEN 1.0::DOUBLE ELSE greatest(0, least(1, 2 * list_sum(list_transform(range(1, 41),
   lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * t * t))))) END AS p
 FROM (SELECT any_value(n) AS n, any_value(m) AS m, any_value(s) AS s, max(greatest(i / n - below, below - (i - 1) / n)) AS d, d * sqrt(any_value(n)) AS t
  FROM (SELECT i, n, m, s, CASE WHEN abs(z) > 8 THEN CAST(z > 0 AS DOUBLE) WHEN z < 0 THEN 0.5 - {_BELOW} ELSE 0.5 + {_BELOW} END AS below
   FROM (SELECT *, (v - m) / s AS z FROM (SELECT distance AS v, row_number() OVER (ORDER BY distance) AS i, count(*) OVER () AS n, avg(distance) OVER () AS m,
      stddev_samp(distance) OVER () AS s FROM taps
     WHERE distance IS NOT NULL AND CAST('0x' || substr(md5(concat(event_id, ':42')), 1, 8) AS BIGINT) < CAST(floor(0.5 * 4294967296) AS BIGINT))))))
""",
    "taps",
)
def a30(spark, sf):
    tested = quality.ks_normal(taps(spark, sf), "distance", fraction=0.5, seed=42, keys=["event_id"])
    return rounded(tested, "mean", "std", "statistic", "p_value")


@query(
    "q_a31_group_centroid",
    """
SELECT region_code, stop_name, round(avg(x_5179), 3) AS centre_x, round(avg(y_5179), 3) AS centre_y,
  count(*) AS members, min(stop_id) AS stop_id FROM stops WHERE mode = 'T' GROUP BY 1, 2
""",
    "stops",
)
def a31(spark, sf):
    subway = clean_stops(spark, sf).where(F.col("mode") == "T")
    centres = spatial.group_centroid(
        subway, ["region_code", "stop_name"], "x_5179", "y_5179", ["stop_id"], "stop_id"
    )
    return rounded(centres, "centre_x", "centre_y", digits=3)


@query(
    "q_a32_business_day_count",
    """
SELECT strftime(d, '%Y%m') AS ym,
  count(*) FILTER (WHERE isodow(d) < 6 AND d NOT IN (SELECT holiday_date FROM holidays)) AS business_days
FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), last_day(CAST(max(ts) AS DATE)),
  INTERVAL 1 DAY)) AS DATE) AS d FROM orders, (SELECT max(ts) AS ts FROM events)) GROUP BY 1
""",
    "holidays",
)
def a32(spark, sf):
    last = table(spark, sf, "events").agg(F.max(F.to_date("ts"))).scalar()
    span = table(spark, sf, "orders").agg(F.min(F.to_date("o_orderdate")).alias("lo")).withColumn("hi", last)
    return business_day_counts(month_span(span, F.col("lo"), F.col("hi")), holidays(spark))


@query(
    "q_a33_funnel",
    """
SELECT *, round_even(rows / first_value(rows) OVER (ORDER BY step) * 100.0, 2) AS pct_of_first FROM (
SELECT 0 AS step, 'taps' AS stage, count(*) AS rows, count(DISTINCT card_id) AS keys FROM taps
UNION ALL SELECT 1, 'adults', count(*), count(DISTINCT card_id) FROM taps WHERE user_type = 1
UNION ALL SELECT 2, 'trips', count(*), count(DISTINCT card_id) FROM trips
UNION ALL SELECT 3, 'business_days', count(*), count(DISTINCT card_id) FROM work_days)
""",
    "taps",
    "trips",
    "work_days",
)
def a33(spark, sf):
    from tapflow.operators.calendar import business_days_only

    legs, trips = taps(spark, sf), trips_of(spark, sf)
    stages = {
        "taps": legs,
        "adults": clean.adults(legs),
        "trips": trips,
        "business_days": business_days_only(trips, "op_date", holidays(spark)),
    }
    return quality.funnel(stages, "card_id")
