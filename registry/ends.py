"""E: end-to-end jobs. P14/A13 and G8 are parts of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapflow.operators import clean, od, quality
from tapflow.operators.calendar import business_day_counts, business_days_only
from tapflow.plans import jobs
from tapflow.schema import DAILY_LOAD, PUBLISHED_OD_COLUMNS
from tapflow.session import scratch_path

from .aggregates import OD_ROUNDED, anchored, cell_od_sql, clean_stops, modal_views, trips_of
from .catalog import query, rounded
from .joins import district_centres
from .places import monthly_od, wkt_sql
from .standin import cte, holidays, month_taps, raw_stops, stop_snapshots, taps
from .windows import DWELL_ROUNDED, CATCHMENT_METRES, dwell_stats_sql, dwell_views
from tapflow.functions.geo import LOCAL_FROM, LOCAL_TO


@query(
    "q_e1_monthly_commute_od",
    """
SELECT ym, board_stop, board_region, board_mode, alight_stop, alight_region, alight_mode, trip_type, trips,
  distance_avg, distance_median, time_avg, time_median, board_name, board_grid, alight_name, alight_grid FROM od_grid
""",
    "od_grid",
)
def e1(spark, sf):
    return rounded(monthly_od(spark, sf), *OD_ROUNDED)


@query(
    "q_e1_commute_od_of_months",
    """
SELECT ym, board_stop, split_part(board_region, '@', 1) AS board_region, board_mode, alight_stop, split_part(alight_region, '@', 1) AS alight_region,
  alight_mode, trip_type, trips, distance_avg, distance_median, time_avg, time_median, board_name, board_grid, alight_name, alight_grid FROM m_od_grid
""",
    "m_od_grid",
)
def e1_months(spark, sf):
    return rounded(jobs.commute_od_of_months(month_taps(spark, sf), stop_snapshots(spark, sf), holidays(spark)), *OD_ROUNDED)


cte(
    "tagged_sc",
    """
SELECT t.*, b.cell_id AS board_cell, a.cell_id AS alight_cell, b.stop_name AS board_name, a.stop_name AS alight_name,
  b.legal_dong AS board_dong, a.legal_dong AS alight_dong, b.gps_x AS board_x, b.gps_y AS board_y,
  a.gps_x AS alight_x, a.gps_y AS alight_y
FROM (SELECT * FROM leg_trips WHERE NOT coalesce(board_ts > alight_ts, FALSE)) t
LEFT JOIN station_cells b ON t.board_stop = b.stop_id AND t.board_region = b.region_code AND t.board_mode = b.mode
LEFT JOIN station_cells a ON t.alight_stop = a.stop_id AND t.alight_region = a.region_code AND t.alight_mode = a.mode
""",
    "leg_trips",
    "station_cells",
)
modal_views("tagged_sc", "sc_")
dwell_views("tagged_sc", "sc_anchor_cells", "sc_dwell_events")


@query("q_e2_cell_commute_od", cell_od_sql("tagged_sc", "sc_anchor_cells"), "tagged_sc", "sc_anchor_cells")
def e2(spark, sf):
    raw = raw_stops(spark, sf).drop("cell_id")
    return rounded(jobs.cell_commute_od_job(taps(spark, sf), raw), "distance_avg", "time_avg")


@query("q_e3_dwell_job", dwell_stats_sql("sc_dwell_events", "station_cells"), "sc_dwell_events", "station_cells")
def e3(spark, sf):
    stops = jobs.station_cells(jobs.staged(clean_stops(spark, sf).drop("cell_id"), "stops"))
    return rounded(jobs.dwell_job(taps(spark, sf), stops), *DWELL_ROUNDED)


cte(
    "month_days",
    """
SELECT ym, count(*) FILTER (WHERE isodow(d) < 6 AND d NOT IN (SELECT holiday_date FROM holidays)) AS business_days
FROM (SELECT ym, CAST(unnest(generate_series(strptime(ym || '01', '%Y%m%d'),
        last_day(CAST(strptime(ym || '01', '%Y%m%d') AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT DISTINCT ym FROM od_grid)) GROUP BY 1
""",
    "od_grid",
    "holidays",
)
_LOCAL = f"translate({{}}, '{LOCAL_FROM}', '{LOCAL_TO}')"
cte(
    "published",
    f"""
SELECT o.ym AS standard_ym, board_stop AS departure_station_id, board_name AS departure_station_name,
  board_region AS departure_region_code, board_mode AS departure_station_type,
  {_LOCAL.format("board_grid")} AS departure_grid_id, alight_stop AS arrival_station_id,
  alight_name AS arrival_station_name, alight_region AS arrival_region_code, alight_mode AS arrival_station_type,
  {_LOCAL.format("alight_grid")} AS arrival_grid_id,
  CASE trip_type WHEN 'morning' THEN '출근' WHEN 'evening' THEN '퇴근' END AS purpose_name,
  round_even(trips / business_days, 1) AS daily_use_count, time_median AS median_elapse_time,
  time_avg AS average_elapse_time, distance_median AS median_distance, distance_avg AS average_distance,
  {wkt_sql("board_grid")} AS departure_station_geometry, {wkt_sql("alight_grid")} AS arrival_station_geometry
FROM od_grid o JOIN month_days d ON o.ym = d.ym
""",
    "od_grid",
    "month_days",
)
PUBLISHED_DOUBLES = ("average_elapse_time", "median_elapse_time", "average_distance", "median_distance")


@query("q_p14_to_published_od", f"SELECT {', '.join(PUBLISHED_OD_COLUMNS)} FROM published", "published")
def p14(spark, sf):
    od = jobs.staged(monthly_od(spark, sf), "od")
    days = business_day_counts(od.select("ym"), holidays(spark))
    return rounded(clean.to_published_od(od, days), *PUBLISHED_DOUBLES)


_NUMERIC = {
    "daily_use_count": "DECIMAL(10,1)",
    **{c: "DECIMAL(6,0)" for c in PUBLISHED_DOUBLES},
}


@query(
    "q_e4_publish_od",
    "SELECT "
    + ", ".join(f"CAST(CAST({c} AS {_NUMERIC[c]}) AS DOUBLE) AS {c}" if c in _NUMERIC else c for c in PUBLISHED_OD_COLUMNS)
    + " FROM published",
    "published",
)
def e4(spark, sf):
    path = scratch_path(spark, "published-od")
    loaded = jobs.publish_od(jobs.staged(monthly_od(spark, sf), "od"), holidays(spark), path)
    # As doubles again: decimals differ in type, not in value, between the two sides.
    return loaded.withColumns({c: F.col(c).cast("double") for c in _NUMERIC})


@query(
    "q_a12_publish_daily",
    f"""
SELECT op_date AS standard_date, lpad(CAST(hour(board_ts) AS VARCHAR), 2, '0') AS hour, CAST(board_stop AS VARCHAR) AS departure_station_id,
  b.stop_name AS departure_station_name, board_region AS departure_region_code, board_mode AS departure_station_type,
  {_LOCAL.format('b.grid_id')} AS departure_grid_id, CAST(alight_stop AS VARCHAR) AS arrival_station_id,
  a.stop_name AS arrival_station_name, alight_region AS arrival_region_code, alight_mode AS arrival_station_type,
  {_LOCAL.format('a.grid_id')} AS arrival_grid_id, CASE trip_type WHEN 'morning' THEN '출근' ELSE '퇴근' END AS trip_type,
  CAST(count(*) AS DOUBLE) AS use_count, CAST(count(DISTINCT card_id) AS DOUBLE) AS unique_use_count,
  CAST(CAST(median(total_ride_sec) AS DECIMAL(6, 0)) AS DOUBLE) AS median_elapse_time, CAST(CAST(round(avg(total_ride_sec), 6) AS DECIMAL(6, 0)) AS DOUBLE) AS average_elapse_time,
  CAST(CAST(median(total_distance) AS DECIMAL(6, 0)) AS DOUBLE) AS median_distance, CAST(CAST(round(avg(total_distance), 6) AS DECIMAL(6, 0)) AS DOUBLE) AS average_distance,
  CAST(CAST(median(max_transfers) AS DECIMAL(6, 1)) AS DOUBLE) AS median_transfer_count, CAST(CAST(round(avg(max_transfers), 6) AS DECIMAL(6, 1)) AS DOUBLE) AS average_transfer_count,
  {wkt_sql('b.grid_id')} AS departure_station_geometry, {wkt_sql('a.grid_id')} AS arrival_station_geometry
FROM (SELECT * FROM matched WHERE isodow(op_date) < 6 AND op_date NOT IN (SELECT holiday_date FROM holidays)) m
LEFT JOIN stops b ON board_stop = b.stop_id AND board_region = b.region_code AND board_mode = b.mode
LEFT JOIN stops a ON alight_stop = a.stop_id AND alight_region = a.region_code AND alight_mode = a.mode
GROUP BY ALL
""",
    "matched",
    "stops",
    "holidays",
)
def a12_daily(spark, sf):
    """Loaded at a path in two levels, month and day, and read back; decimals as doubles, as above."""
    trips, stops, found = anchored(spark, sf)
    path = scratch_path(spark, "published-daily")
    matched = od.match_commutes(business_days_only(trips, "op_date", holidays(spark)), found)
    rows = jobs.publish_daily_od(matched, stops, path)
    return rows.withColumns({c: F.col(c).cast("double") for c in DAILY_LOAD.numerics})


# --- reports, one (section, item, value) row per figure -------------------------------------------


def figures(section: str, df, item, *values: str):
    """Long form of a report part; several values go under ``item.value``."""
    rows = F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                (F.concat(item, F.lit(f".{v}")) if len(values) > 1 else item).alias("item"),
                F.col(v).cast("double").alias("value"),
            )
            for v in values
        ]
    )
    return df.select(F.inline(rows))


def stacked(parts):
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


cte(
    "around",
    """
SELECT * FROM trips WHERE board_stop IN (SELECT stop_id FROM near_stops) OR alight_stop IN (SELECT stop_id FROM near_stops)
""",
    "trips",
    "near_stops",
)
cte(
    "around_two",
    """
SELECT *, row_number() OVER (PARTITION BY op_date, card_id ORDER BY board_ts, txn_id) AS trip_no FROM around
QUALIFY count(*) OVER (PARTITION BY op_date, card_id) = 2
""",
    "around",
)
_BACK = """
SELECT a.op_date, a.card_id FROM around_two a JOIN around_two b
 ON a.op_date = b.op_date AND a.card_id = b.card_id AND a.trip_no = 1 AND b.trip_no = 2
WHERE a.board_stop IN (SELECT stop_id FROM near_stops) AND b.alight_stop IN (SELECT stop_id FROM near_stops)
"""
cte("around_back", _BACK, "around_two", "near_stops")
cte(
    "around_commute",
    _BACK
    + """ AND CAST(a.alight_ts AS TIME) BETWEEN TIME '07:00:00' AND TIME '10:00:00'
 AND CAST(b.board_ts AS TIME) BETWEEN TIME '17:00:00' AND TIME '20:00:00'""",
    "around_two",
    "near_stops",
)
cte(
    "around_gaps",
    """
SELECT round(sqrt((s.x_5179 - d.x_5179) * (s.x_5179 - d.x_5179) + (s.y_5179 - d.y_5179) * (s.y_5179 - d.y_5179)), 2)
  AS distance
FROM around_two a JOIN around_two b ON a.op_date = b.op_date AND a.card_id = b.card_id AND a.trip_no = 1 AND b.trip_no = 2
LEFT JOIN stops s ON a.alight_stop = s.stop_id AND a.alight_region = s.region_code AND a.alight_mode = s.mode
LEFT JOIN stops d ON b.board_stop = d.stop_id AND b.board_region = d.region_code AND b.board_mode = d.mode
""",
    "around_two",
    "stops",
)


def _stage(name: str, source: str) -> str:
    return f"""SELECT 'funnel' AS section, '{name}.rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM {source}
UNION ALL SELECT 'funnel', '{name}.keys', CAST(count(DISTINCT card_id) AS DOUBLE) FROM {source}"""


def _curve(name: str, end: str) -> str:
    used = f"(SELECT time_bucket(INTERVAL 30 MINUTE, {end}_ts) AS bin FROM around WHERE {end}_stop IN (SELECT stop_id FROM near_stops))"
    return f"""SELECT '{name}', strftime(b.bin, '%Y-%m-%d %H:%M:%S'), CAST(count(u.bin) AS DOUBLE) FROM
 (SELECT unnest(generate_series(min(bin), max(bin), INTERVAL 30 MINUTE)) AS bin FROM {used}) b
 LEFT JOIN {used} u ON b.bin = u.bin GROUP BY b.bin"""


_NEAR = "(SELECT stop_id FROM near_stops)"
_IN = "t JOIN {} c ON t.op_date = c.op_date AND t.card_id = c.card_id"
_G8 = [
    _stage("touching", "around"),
    _stage("boarding", f"(SELECT * FROM around WHERE board_stop IN {_NEAR})"),
    _stage("alighting", f"(SELECT * FROM around WHERE alight_stop IN {_NEAR})"),
    _stage("internal", f"(SELECT * FROM around WHERE board_stop IN {_NEAR} AND alight_stop IN {_NEAR})"),
    _stage("two_trips", "around_two"),
    _stage("returning", f"(SELECT t.* FROM around_two {_IN.format('around_back')})"),
    _stage("commuting", f"(SELECT t.* FROM around_two {_IN.format('around_commute')})"),
    """SELECT 'trips_per_card', CAST(times AS VARCHAR), CAST(count(*) AS DOUBLE) FROM
 (SELECT op_date, card_id, count(*) AS times FROM around GROUP BY 1, 2) GROUP BY times""",
    *[
        f"SELECT 'means', '{end}.{name}', round(avg({col}), 2) FROM around WHERE {end}_stop IN {_NEAR}"
        for end in ("board", "alight")
        for name, col in (("mean_sec", "total_ride_sec"), ("mean_m", "total_distance"))
    ],
    _curve("board_curve", "board"),
    _curve("alight_curve", "alight"),
    """SELECT 'return_bins', b.label, CAST(count(g.distance) AS DOUBLE) FROM (VALUES """
    + ", ".join(
        f"({lo}, {hi}, '{label}')"
        for lo, hi, label in zip(quality.DISTANCE_EDGES, quality.DISTANCE_EDGES[1:], quality.DISTANCE_LABELS)
    )
    + """) b(lo, hi, label) LEFT JOIN around_gaps g ON g.distance >= b.lo AND g.distance < b.hi GROUP BY b.label""",
    f"""SELECT 'return_bins', 'no class', CAST(count(*) AS DOUBLE) FROM around_gaps
 WHERE distance IS NULL OR distance < {quality.DISTANCE_EDGES[0]} OR distance >= {quality.DISTANCE_EDGES[-1]} HAVING count(*) > 0""",
    f"""SELECT 'commuters', concat_ws('.', op_date, card_id, board_stop, alight_stop), CAST(count(*) AS DOUBLE)
 FROM (SELECT t.* FROM around_two {_IN.format('around_commute')}) GROUP BY op_date, card_id, board_stop, alight_stop""",
    """SELECT 'hours', CAST(hour(a) AS VARCHAR) || '.' || CAST(hour(b) AS VARCHAR), CAST(count(*) AS DOUBLE)
 FROM (SELECT min(alight_ts) AS a, max(board_ts) AS b FROM around_two GROUP BY op_date, card_id) GROUP BY hour(a), hour(b)""",
]


@query(
    "q_g8_catchment_report",
    " UNION ALL ".join(_G8),
    "around",
    "around_two",
    "around_back",
    "around_commute",
    "around_gaps",
    "near_stops",
)
def g8(spark, sf):
    stops = jobs.staged(clean_stops(spark, sf), "stops")
    trips = jobs.staged(trips_of(spark, sf), "trips")
    report = jobs.catchment_report(
        trips, stops, district_centres(stops), CATCHMENT_METRES, ["op_date", "card_id"]
    )
    ends = ["op_date", "card_id", "board_stop", "alight_stop"]
    stamp = F.date_format("bin", "yyyy-MM-dd HH:mm:ss")
    hours = report["hours"].select(
        "arrival_hour",
        F.inline(
            F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"h{h:02d}").alias("n")) for h in range(24)])
        ),
    )
    return stacked(
        [
            figures("funnel", report["funnel"], F.col("stage"), "rows", "keys"),
            figures("trips_per_card", report["trips_per_card"], F.col("times").cast("string"), "keys"),
            figures("means", report["means"], F.col("end"), "mean_sec", "mean_m"),
            figures("board_curve", report["board_curve"], stamp, "n"),
            figures("alight_curve", report["alight_curve"], stamp, "n"),
            figures("return_bins", report["return_bins"], F.coalesce("bin", F.lit("no class")), "n"),
            figures("hours", hours.where(F.col("n") > 0), F.concat_ws(".", "arrival_hour", "h"), "n"),
            figures("commuters", report["commuters"].groupBy(*ends).count(), F.concat_ws(".", *ends), "count"),
        ]
    )


_REPORTED = ["event_id", "op_date", "card_id", "region_code", "vehicle_id", "mode_code", "board_stop", "alight_stop"]
_REPORTED += ["operator_id", "card_kind", "route_id", "board_ts", "alight_ts", "txn_id", "transfer_no", "user_type", "riders", "distance", "ride_sec"]
# Times as text, with the faults of q_p10_bad_timestamps.
_STAMPS = """FROM (SELECT ts_text, coalesce(TRY_CAST(substr(ts_text, 11, 1) AS INTEGER) > 5 OR TRY_CAST(substr(ts_text, 13, 1) AS INTEGER) > 5, FALSE) AS bad_digit,
  try_strptime(ts_text, '%Y%m%d%H%M%S') IS NULL AS unparsable,
  coalesce(date_diff('day', op_date, CAST(try_strptime(ts_text, '%Y%m%d%H%M%S') AS DATE)) NOT IN (0, 1), FALSE) AS other_day
 FROM (SELECT op_date, CASE event_id % 11 WHEN 3 THEN strftime(board_ts, '%Y%m%d%H') || '6130' WHEN 5 THEN strftime(board_ts, '%Y%m%d') || '2A0000'
  WHEN 7 THEN '20230115' || strftime(board_ts, '%H%M%S') WHEN 9 THEN NULL ELSE strftime(board_ts, '%Y%m%d%H%M%S') END AS ts_text FROM taps))
 WHERE ts_text IS NOT NULL"""
_AUDIT = "FROM modes m LEFT JOIN raw_stops s ON m.board_stop = s.stop_id AND m.region_code = s.region_code AND m.mode = s.mode"
_E5 = [
    *[
        f"SELECT 'nulls' AS section, '{c}.{name}' AS item, CAST({value} AS DOUBLE) AS value FROM taps"
        for c in _REPORTED
        for name, value in {
            "nulls": f"count(*) - count({c})",
            "total": "count(*)",
            "null_pct": f"round_even((count(*) - count({c})) / count(*) * 100.0, 2)",
        }.items()
    ],
    *[
        f"SELECT 'columns', '{c}.{name}', CAST({value} AS DOUBLE) FROM taps"
        for c in _REPORTED
        for name, value in {
            "total_count": f"count({c})",
            "unique_count": f"count(DISTINCT {c})",
            "null_count": f"count(*) - count({c})",
            "blank_count": f"count(*) FILTER (WHERE CAST({c} AS VARCHAR) = '')",
        }.items()
    ],
    *[
        f"SELECT 'columns', '{c}.{name}', CAST({value} AS DOUBLE) FROM (SELECT count(*) AS n FROM taps WHERE {c} IS NOT NULL GROUP BY {c})"
        for c in _REPORTED
        for name, value in {"top_count": "max(n)", "rare_count": "min(n)"}.items()
    ],
    """SELECT 'key_copies', 'keys', CAST(count(*) AS DOUBLE) FROM
 (SELECT 1 FROM raw_stops GROUP BY stop_id, region_code, mode HAVING count(*) > 1)""",
    "SELECT 'card_lengths', CAST(length(card_id) AS VARCHAR), CAST(count(*) AS DOUBLE) FROM taps GROUP BY length(card_id)",
    *[
        f"SELECT 'coordinates', '{k}', CAST(count(*) FILTER (WHERE {t}) AS DOUBLE) FROM raw_stops"
        for k, t in {
            "missing": "gps_x IS NULL OR gps_y IS NULL",
            "sentinel": "gps_x >= 1000 OR gps_y >= 1000",
            "zero": "gps_x = 0 OR gps_y = 0",
            "outside": "gps_x < 124 OR gps_x > 132 OR gps_y < 33 OR gps_y > 38.9",
        }.items()
    ],
    "SELECT 'inverted', 'rows', CAST(count(*) AS DOUBLE) FROM taps WHERE alight_ts < board_ts AND board_stop <> alight_stop",
    *[
        f"SELECT 'bad_timestamps', '{k}', CAST(count(*) AS DOUBLE) {_STAMPS} AND ({t})"
        for k, t in {"all.rows": "bad_digit OR unparsable OR other_day", "all.bad_digit": "bad_digit", "all.unparsable": "unparsable", "all.other_day": "other_day"}.items()
    ],
    f"SELECT 'board_stops', 'all.matched', CAST(count(s.stop_id) AS DOUBLE) {_AUDIT}",
    f"SELECT 'board_stops', 'all.unmatched', CAST(count(*) - count(s.stop_id) AS DOUBLE) {_AUDIT}",
    f"SELECT 'by_region', m.region_code || '.matched', CAST(count(s.stop_id) AS DOUBLE) {_AUDIT} GROUP BY m.region_code",
    f"SELECT 'by_region', m.region_code || '.rows', CAST(count(*) AS DOUBLE) {_AUDIT} GROUP BY m.region_code",
    f"SELECT 'by_region', 'total.matched', CAST(count(s.stop_id) AS DOUBLE) {_AUDIT}",
    f"SELECT 'by_region', 'total.rows', CAST(count(*) AS DOUBLE) {_AUDIT}",
    """SELECT 'stop_ids', 'all.only_a', CAST(count(*) AS DOUBLE) FROM
 (SELECT l_partkey FROM lineitem EXCEPT SELECT stop_id FROM raw_stops)""",
    """SELECT 'stop_ids', 'all.only_b', CAST(count(*) AS DOUBLE) FROM
 (SELECT stop_id FROM raw_stops EXCEPT SELECT l_partkey FROM lineitem)""",
]


@query("q_e5_quality_report", " UNION ALL ".join(_E5), "taps", "raw_stops", "modes")
def e5(spark, sf):
    from .rows import tap_texts
    from .standin import table

    served = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("stop_id"))
    legs = jobs.staged(taps(spark, sf), "taps")
    report = jobs.quality_report(legs, raw_stops(spark, sf), served, tap_texts(spark, sf))
    whole = F.lit("all")
    return stacked(
        [
            figures("nulls", report["nulls"], F.col("column_name"), "nulls", "total", "null_pct"),
            figures("columns", report["columns"], F.col("column_name"), "total_count", "unique_count", "null_count", "blank_count", "top_count", "rare_count"),
            figures("key_copies", report["key_copies"].agg(F.count(F.lit(1)).alias("n")), F.lit("keys"), "n"),
            figures("card_lengths", report["card_lengths"], F.col("len").cast("string"), "n"),
            figures("coordinates", report["coordinates"], F.col("issue"), "n"),
            figures("inverted", report["inverted"], F.lit("rows"), "rows"),
            figures("bad_timestamps", report["bad_timestamps"], whole, "rows", "bad_digit", "unparsable", "other_day"),
            figures("board_stops", report["board_stops"], whole, "matched", "unmatched"),
            figures("by_region", report["board_stops_by_region"], F.col("grp"), "matched", "rows"),
            figures("stop_ids", report["stop_ids"], whole, "only_a", "only_b"),
        ]
    )
