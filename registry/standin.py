"""Fare-card views over the driver tables, in Spark and in SQL.

``events`` plays taps and the whole of ``part`` plays stops. Ten neighbouring
users share a district of one hundred stops, so stops, cards and pairs grow
with the data. Some stops carry swapped, one-sided, sentinel or missing
coordinates; taps of region R9 find no stop.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapflow.functions.times import floor_time


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def taps(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    e = events.select(
        "event_id", "user_id", "event_type", "value", floor_time(F.col("ts"), "second").alias("board_ts"), k.alias("k")
    )
    user, h = F.col("user_id"), F.hour("board_ts")
    base = F.floor(user / 10) * 100
    home, work = base + (user * 7) % 100, base + (user * 13 + 50) % 100
    am = h < 12
    code = (
        F.when(F.col("event_type") == "click", 201)
        .when(F.col("event_type") == "view", 250)
        .when(F.col("event_type") == "purchase", 299)
        .when(F.col("event_type") == "signup", 100)
        .otherwise(440)
    )
    ride = F.lit(300) + F.col("k") * 30
    # A card's half day; the transfer number is a column of real extracts.
    w = Window.partitionBy("user_id", F.to_date("board_ts"), am).orderBy("board_ts", "event_id")
    return e.select(
        "event_id",
        F.to_date("board_ts").alias("op_date"),
        F.concat(F.lit("OP"), (user % 3).cast("string")).alias("operator_id"),
        user.cast("string").alias("card_id"),
        F.when(F.col("k") == 97, "R9").otherwise("R0").alias("region_code"),
        F.when(user % 5 == 0, "02").otherwise("01").alias("card_kind"),
        F.when(~code.between(200, 299), F.concat(F.lit("V"), F.col("k").cast("string"))).alias("vehicle_id"),
        code.alias("mode_code"),
        F.concat(F.lit("R"), (F.col("k") % 10).cast("string")).alias("route_id"),
        "board_ts",
        F.when(F.col("k") < 70, F.when(am, home).otherwise(work)).otherwise(base + F.col("k")).alias("board_stop"),
        F.when(F.col("k") != 98, F.timestamp_add("SECOND", ride, F.col("board_ts"))).alias("alight_ts"),
        F.when(F.col("k") == 98, None)
        .when(F.col("k") < 70, F.when(am, work).otherwise(home))
        .otherwise(base + (F.col("k") * 3 + user) % 100)
        .alias("alight_stop"),
        F.when(am, 1).otherwise(2).alias("txn_id"),
        (F.row_number().over(w) - 1).alias("transfer_no"),
        F.when(user % 8 == 7, 4).otherwise(1).alias("user_type"),
        (F.lit(1) + F.col("k") % 3).alias("riders"),
        F.round(F.col("value") * 100, 0).alias("distance"),
        ride.cast("double").alias("ride_sec"),
    )


def raw_stops(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    key = F.col("p_partkey")
    local, district = key % 100, F.floor(key / 100)
    lon = F.lit(126.0) + (district % 50) * F.lit(0.08) + (local % 10) * F.lit(0.006)
    lat = F.lit(34.5) + (F.floor(district / 50) % 40) * F.lit(0.08) + F.floor(local / 10) * F.lit(0.006)

    def faulty(good, other, one_sided):
        return (
            F.when(local == 95, None)
            .when(local == 96, F.lit(99999.0))
            .when(local == 94, one_sided)
            .when(local % 25 == 3, other)
            .otherwise(good)
        )

    return p.select(
        key.alias("stop_id"),
        F.lit("R0").alias("region_code"),
        F.explode(F.array(F.lit("T"), F.lit("B"))).alias("mode"),
        F.concat("p_name", F.lit(" "), district.cast("string")).alias("stop_name"),
        (F.lit(1000000) + district).cast("string").alias("legal_dong"),
        faulty(lon, lat, lon).alias("gps_x"),
        faulty(lat, lon, F.lit(127.1)).alias("gps_y"),
        (key).alias("cell_id"),
        "p_type",
    )


#: Month of each stop snapshot; the one before the first month of taps serves it, the last is later than all taps.
SNAPSHOTS = ["202312", "202402", "202403"]


def month_taps(spark: SparkSession, sf: str) -> DataFrame:
    """Taps of two months: a third of the cards travel in January, a third in February, the others in both."""
    legs = taps(spark, sf)
    turn, late = F.col("card_id").cast("int") % 3, F.dayofmonth("op_date") >= 16
    days = F.when(turn == 0, 31).when((turn == 2) & late, 16).otherwise(0)
    return legs.withColumns(
        {**{c: F.timestamp_add("DAY", days, F.col(c)) for c in ("board_ts", "alight_ts")}, "op_date": F.date_add("op_date", days)}
    )


def stop_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Three extracts of the stops: in February some are renamed, some moved, some gone, in March some are back."""
    k, later = F.col("stop_id"), F.col("ym") >= "202402"
    shots = raw_stops(spark, sf).withColumn("ym", F.explode(F.array(*[F.lit(m) for m in SNAPSHOTS])))
    return shots.where(~((F.col("ym") == "202402") & (k % 50 == 7))).withColumns(
        {
            "stop_name": F.when(later & (k % 3 == 0), F.concat("stop_name", F.lit(" new"))).otherwise(F.col("stop_name")),
            "gps_x": F.when(later & (k % 4 == 0) & (F.col("gps_x") < 1000), F.col("gps_x") + 0.003).otherwise(F.col("gps_x")),
        }
    )


def holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(dt.date(2024, 1, 1),)], "holiday_date date")


# --- the same views for the oracle ------------------------------------------------------------

CTE = {}
NEEDS: dict[str, list[str]] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTE[name] = text.strip()
    NEEDS[name] = list(needs)


def views_with(prefix: str, root: str, **other: str) -> None:
    """The views below ``root`` once more, each name led by ``prefix``, on other base views."""

    def closure(name: str) -> list[str]:
        return [x for n in NEEDS[name] for x in closure(n)] + [name]

    names = [n for n in dict.fromkeys(closure(root)) if n not in other]
    new = {n: f"{prefix}{n}" for n in names} | other
    for n in names:
        text = re.sub(r"\b(FROM|JOIN)(\s+)(\w+)", lambda m: m[1] + m[2] + new.get(m[3], m[3]), CTE[n])
        cte(new[n], text, *[new[x] for x in NEEDS[n]])


def sql(body: str, *needs: str) -> str:
    """``body`` preceded by the views it needs, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for n in NEEDS[name]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body.strip()
    recursive = "RECURSIVE " if any("/*recursive*/" in CTE[n] for n in order) else ""
    views = ",\n".join(f"{n} AS ({CTE[n]})" if not CTE[n].startswith("(") else f"{n}{CTE[n]}" for n in order)
    return f"WITH {recursive}{views}\n{body.strip()}"


cte(
    "taps",
    """
SELECT event_id, CAST(ts AS DATE) AS op_date, 'OP' || (user_id % 3) AS operator_id,
  CAST(user_id AS VARCHAR) AS card_id,
  CASE WHEN k = 97 THEN 'R9' ELSE 'R0' END AS region_code,
  CASE WHEN user_id % 5 = 0 THEN '02' ELSE '01' END AS card_kind,
  CASE WHEN mode_code NOT BETWEEN 200 AND 299 THEN 'V' || k END AS vehicle_id,
  mode_code, 'R' || (k % 10) AS route_id, ts AS board_ts,
  CASE WHEN k < 70 THEN (CASE WHEN h < 12 THEN home ELSE work END) ELSE base + k END AS board_stop,
  CASE WHEN k <> 98 THEN ts + to_seconds(300 + k * 30) END AS alight_ts,
  CASE WHEN k = 98 THEN NULL WHEN k < 70 THEN (CASE WHEN h < 12 THEN work ELSE home END)
       ELSE base + (k * 3 + user_id) % 100 END AS alight_stop,
  CASE WHEN h < 12 THEN 1 ELSE 2 END AS txn_id,
  CAST(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), CASE WHEN h < 12 THEN 1 ELSE 2 END
       ORDER BY ts, event_id) - 1 AS INTEGER) AS transfer_no,
  CASE WHEN user_id % 8 = 7 THEN 4 ELSE 1 END AS user_type,
  1 + k % 3 AS riders, round(value * 100, 0) AS distance, CAST(300 + k * 30 AS DOUBLE) AS ride_sec
FROM (SELECT *, hour(ts) AS h, (user_id // 10) * 100 AS base,
        (user_id // 10) * 100 + (user_id * 7) % 100 AS home,
        (user_id // 10) * 100 + (user_id * 13 + 50) % 100 AS work,
        CASE event_type WHEN 'click' THEN 201 WHEN 'view' THEN 250 WHEN 'purchase' THEN 299
                        WHEN 'signup' THEN 100 ELSE 440 END AS mode_code
      FROM (SELECT event_id, user_id, event_type, value, date_trunc('second', ts) AS ts,
                   CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))
""",
)
cte(
    "raw_stops",
    """
SELECT p_partkey AS stop_id, 'R0' AS region_code, unnest(['T', 'B']) AS mode,
  p_name || ' ' || district AS stop_name, CAST(1000000 + district AS VARCHAR) AS legal_dong,
  CASE WHEN l = 95 THEN NULL WHEN l = 96 THEN 99999.0::DOUBLE WHEN l = 94 THEN lon
       WHEN l % 25 = 3 THEN lat ELSE lon END AS gps_x,
  CASE WHEN l = 95 THEN NULL WHEN l = 96 THEN 99999.0::DOUBLE WHEN l = 94 THEN 127.1::DOUBLE
       WHEN l % 25 = 3 THEN lon ELSE lat END AS gps_y,
  p_partkey AS cell_id, p_type
FROM (SELECT *,
        126.0::DOUBLE + (district % 50) * 0.08::DOUBLE + (l % 10) * 0.006::DOUBLE AS lon,
        34.5::DOUBLE + ((district // 50) % 40) * 0.08::DOUBLE + (l // 10) * 0.006::DOUBLE AS lat
      FROM (SELECT *, p_partkey // 100 AS district, p_partkey % 100 AS l FROM part))
""",
)
cte("holidays", "SELECT DATE '2024-01-01' AS holiday_date")

# Snyder (1987), transverse Mercator on GRS80 with the parameters of EPSG:5179.
_E2 = "0.006694380022900788::DOUBLE"
_EP2 = "0.006739496775478858::DOUBLE"
_ARC = (
    "6378137.0::DOUBLE * (({e2c0}) * {p} - ({e2c1}) * sin(2.0::DOUBLE * {p})"
    " + ({e2c2}) * sin(4.0::DOUBLE * {p}) - ({e2c3}) * sin(6.0::DOUBLE * {p}))"
)


def _arc(p: str) -> str:
    e2 = 0.006694380022900788
    return _ARC.format(
        p=p,
        e2c0=f"{1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256!r}::DOUBLE",
        e2c1=f"{3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024!r}::DOUBLE",
        e2c2=f"{15 * e2**2 / 256 + 45 * e2**3 / 1024!r}::DOUBLE",
        e2c3=f"{35 * e2**3 / 3072!r}::DOUBLE",
    )


def metres_sql(source: str, lon: str, lat: str) -> str:
    """``source`` with ``x_5179`` and ``y_5179``."""
    return f"""
SELECT * EXCLUDE (p_, n_, t_, c_, a_),
  1000000.0::DOUBLE + 0.9996::DOUBLE * n_ * (a_ + (1 - t_ + c_) * pow(a_, 3) / 6
    + (5 - 18 * t_ + t_ * t_ + 72 * c_ - 58 * {_EP2}) * pow(a_, 5) / 120) AS x_5179,
  2000000.0::DOUBLE + 0.9996::DOUBLE * ({_arc("p_")} - {_arc("radians(38.0::DOUBLE)")}
    + n_ * tan(p_) * (a_ * a_ / 2 + (5 - t_ + 9 * c_ + 4 * c_ * c_) * pow(a_, 4) / 24
    + (61 - 58 * t_ + t_ * t_ + 600 * c_ - 330 * {_EP2}) * pow(a_, 6) / 720)) AS y_5179
FROM (SELECT *, 6378137.0::DOUBLE / sqrt(1 - {_E2} * sin(p_) * sin(p_)) AS n_, tan(p_) * tan(p_) AS t_,
        {_EP2} * cos(p_) * cos(p_) AS c_, radians({lon} - 127.5::DOUBLE) * cos(p_) AS a_
      FROM (SELECT *, radians({lat}) AS p_ FROM ({source})))
"""


def cell_sql(x: str, y: str) -> str:
    return f"""
CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN
  substr('ABCDEFG', CAST(greatest(0, least(6, floor({x} / 100000) - 7)) AS INTEGER) + 1, 1)
  || substr('BCDEFGH', CAST(greatest(0, least(6, floor({y} / 100000) - 14)) AS INTEGER) + 1, 1)
  || lpad(CAST(CAST(floor(abs({x})) AS BIGINT) % 100000 AS VARCHAR), 5, '0')
  || lpad(CAST(CAST(floor(abs({y})) AS BIGINT) % 100000 AS VARCHAR), 5, '0') END
"""


cte(
    "fixed_stops",
    """
SELECT * EXCLUDE (gps_x, gps_y),
  CASE WHEN gps_y > 100 AND gps_x < 100 THEN gps_y ELSE gps_x END AS gps_x,
  CASE WHEN gps_y > 100 AND gps_x < 100 THEN gps_x ELSE gps_y END AS gps_y,
  CAST(gps_y > 100 AND gps_x < 100 AS INTEGER) AS y_fixed,
  CAST((gps_y > 100) <> (gps_x < 100) AS INTEGER) AS xy_suspect
FROM raw_stops WHERE gps_x < 1000 AND gps_y < 1000
""",
    "raw_stops",
)
cte(
    "stops",
    f"""
SELECT stop_id, region_code, mode, stop_name, legal_dong, gps_x, gps_y, cell_id, xy_suspect, p_type, x_5179, y_5179,
  {cell_sql("x_5179", "y_5179")} AS grid_id
FROM (SELECT * EXCLUDE (x_5179, y_5179), CASE WHEN xy_suspect = 0 THEN x_5179 END AS x_5179,
             CASE WHEN xy_suspect = 0 THEN y_5179 END AS y_5179
      FROM ({metres_sql("SELECT * FROM fixed_stops", "gps_x", "gps_y")}))
""",
    "fixed_stops",
)
cte(
    "transfer_map",
    """
SELECT CAST(s.stop_id AS VARCHAR) AS stop_id, s.region_code, s.mode, CAST(c.lowest AS VARCHAR) AS canonical_stop_id
FROM stops s JOIN (SELECT stop_name, min(stop_id) AS lowest FROM stops WHERE mode = 'T'
                   GROUP BY stop_name HAVING count(DISTINCT stop_id) > 1) c ON s.stop_name = c.stop_name
WHERE s.mode = 'T'
""",
    "stops",
)
cte("modes", "SELECT *, CASE WHEN mode_code BETWEEN 200 AND 299 THEN 'T' ELSE 'B' END AS mode FROM taps", "taps")
cte(
    "trips",
    """
SELECT op_date, card_id, txn_id,
  arg_min(board_stop, (board_ts, transfer_no)) FILTER (WHERE board_stop IS NOT NULL) AS board_stop,
  arg_max(alight_stop, (alight_ts, transfer_no)) FILTER (WHERE alight_stop IS NOT NULL AND alight_ts IS NOT NULL)
    AS alight_stop,
  min(board_ts) AS board_ts, max(alight_ts) AS alight_ts,
  arg_min(region_code, (board_ts, transfer_no)) AS board_region,
  arg_max(region_code, (alight_ts, transfer_no)) FILTER (WHERE alight_ts IS NOT NULL) AS alight_region,
  arg_min(mode, (board_ts, transfer_no)) AS board_mode,
  arg_max(mode, (alight_ts, transfer_no)) FILTER (WHERE alight_ts IS NOT NULL) AS alight_mode,
  sum(distance) AS total_distance, sum(ride_sec) AS total_ride_sec, max(transfer_no) AS max_transfers
FROM modes WHERE user_type = 1 GROUP BY op_date, card_id, txn_id
HAVING min(board_ts) IS NOT NULL AND max(alight_ts) IS NOT NULL
""",
    "modes",
)
cte(
    "leg_trips",
    """
SELECT s.op_date, s.card_id, s.txn_id, f.board_stop, l.alight_stop, f.board_ts, l.alight_ts,
  f.region_code AS board_region, l.region_code AS alight_region, f.mode AS board_mode, l.mode AS alight_mode,
  s.total_distance, s.total_ride_sec
FROM (SELECT op_date, card_id, txn_id, max(transfer_no) AS hi, sum(distance) AS total_distance,
             sum(ride_sec) AS total_ride_sec FROM modes GROUP BY ALL) s
LEFT JOIN modes f ON s.op_date = f.op_date AND s.card_id = f.card_id AND s.txn_id = f.txn_id AND f.transfer_no = 0
LEFT JOIN modes l ON s.op_date = l.op_date AND s.card_id = l.card_id AND s.txn_id = l.txn_id AND l.transfer_no = s.hi
""",
    "modes",
)
cte(
    "work_days",
    """
SELECT * FROM trips WHERE isodow(op_date) < 6 AND op_date NOT IN (SELECT holiday_date FROM holidays)
""",
    "trips",
    "holidays",
)


def _candidates(kind: str) -> str:
    ends = {"residence": [("board", 6, 10), ("alight", 16, 24)], "office": [("board", 16, 24), ("alight", 6, 10)]}
    return " UNION ALL ".join(
        f"""SELECT t.op_date, t.card_id, t.{e}_stop AS stop_id, hour(t.{e}_ts) AS hour, '{e}' AS type,
  t.{e}_region AS region_code, t.{e}_mode AS mode, s.stop_name, s.gps_y, s.gps_x, s.x_5179 AS x, s.y_5179 AS y,
  t.{e}_ts AS event_ts, '{kind}' AS location_type
FROM work_days t LEFT JOIN stops s ON t.{e}_stop = s.stop_id AND t.{e}_region = s.region_code AND t.{e}_mode = s.mode
WHERE hour(t.{e}_ts) BETWEEN {lo} AND {hi}"""
        for e, lo, hi in ends[kind]
    )


cte("residence", _candidates("residence"), "work_days", "stops")
cte("office", _candidates("office"), "work_days", "stops")
cte(
    "valid_cards",
    """
SELECT card_id FROM residence GROUP BY card_id HAVING count(*) >= 10
INTERSECT SELECT card_id FROM office GROUP BY card_id HAVING count(*) >= 10
""",
    "residence",
    "office",
)
cte(
    "db_rows",
    """
SELECT * FROM (SELECT * FROM residence UNION ALL SELECT * FROM office)
WHERE x IS NOT NULL AND card_id IN (SELECT card_id FROM valid_cards)
""",
    "residence",
    "office",
    "valid_cards",
)
cte(
    "db_points",
    """
SELECT location_type, card_id, x, y, count(*) AS w, min((event_ts, stop_id, region_code, mode)) AS first_row,
  row_number() OVER (ORDER BY location_type, card_id, x, y) AS p
FROM db_rows GROUP BY location_type, card_id, x, y
""",
    "db_rows",
)
cte(
    "db_near",
    """
SELECT a.location_type, a.card_id, a.p, b.p AS q, b.w AS qw FROM db_points a JOIN db_points b
ON a.location_type = b.location_type AND a.card_id = b.card_id
 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 640000
""",
    "db_points",
)
cte("db_core", "SELECT p FROM db_near GROUP BY p HAVING sum(qw) >= 10", "db_near")
cte(
    "db_links",
    "SELECT p, q FROM db_near WHERE p IN (SELECT p FROM db_core) AND q IN (SELECT p FROM db_core)",
    "db_near",
    "db_core",
)
cte(
    "db_reach",
    """
SELECT /*recursive*/ p, p AS q FROM db_core
UNION SELECT r.p, l.q FROM db_reach r JOIN db_links l ON r.q = l.p
""",
    "db_links",
)
cte(
    "db_labels",
    "SELECT r.p, min(o.first_row) AS label FROM db_reach r JOIN db_points o ON r.q = o.p GROUP BY r.p",
    "db_reach",
    "db_points",
)
cte(
    "db_member",
    """
SELECT n.p, min(l.label) AS label FROM db_near n JOIN db_labels l ON n.q = l.p
WHERE n.p NOT IN (SELECT p FROM db_core) GROUP BY n.p
UNION ALL SELECT p, label FROM db_labels
""",
    "db_near",
    "db_labels",
    "db_core",
)
cte(
    "db_main",
    """
SELECT *, row_number() OVER (PARTITION BY location_type, card_id ORDER BY cluster_size DESC, label) AS rk
FROM (SELECT o.location_type, o.card_id, m.label, CAST(sum(o.w) AS BIGINT) AS cluster_size
      FROM db_member m JOIN db_points o ON m.p = o.p GROUP BY ALL)
""",
    "db_member",
    "db_points",
)
cte(
    "anchors",
    """
SELECT DISTINCT r.card_id, r.stop_id, r.stop_name, r.region_code, r.mode AS transport_type, r.location_type,
  round_even(c.cluster_size / t.total_trips * 100, 0) / 100 AS confidence, c.cluster_size, t.total_trips
FROM db_rows r
JOIN db_points o ON r.location_type = o.location_type AND r.card_id = o.card_id AND r.x = o.x AND r.y = o.y
JOIN db_member m ON o.p = m.p
JOIN db_main c ON c.rk = 1 AND c.location_type = o.location_type AND c.card_id = o.card_id AND c.label = m.label
JOIN (SELECT location_type, card_id, count(*) AS total_trips FROM db_rows GROUP BY ALL) t
  ON t.location_type = o.location_type AND t.card_id = o.card_id
""",
    "db_rows",
    "db_points",
    "db_member",
    "db_main",
)


cte(
    "matched",
    """
SELECT p.*, way.trip_type
FROM trips p, (VALUES ('morning', 6, 10, 'residence', 'office'), ('evening', 16, 24, 'office', 'residence')) way(trip_type, lo, hi, origin, target)
WHERE least(hour(p.board_ts), hour(p.alight_ts)) >= way.lo AND greatest(hour(p.board_ts), hour(p.alight_ts)) <= way.hi
  AND p.board_ts IS NOT NULL AND p.alight_ts IS NOT NULL
  AND EXISTS (FROM anchors f WHERE f.confidence >= 0.5 AND f.location_type = way.origin AND f.card_id = p.card_id
    AND f.stop_id = p.board_stop AND f.region_code = p.board_region AND f.transport_type = p.board_mode)
  AND EXISTS (FROM anchors g WHERE g.confidence >= 0.5 AND g.location_type = way.target AND g.card_id = p.card_id
    AND g.stop_id = p.alight_stop AND g.region_code = p.alight_region AND g.transport_type = p.alight_mode)
""",
    "trips",
    "anchors",
)
cte(
    "canonical",
    """
SELECT m.* EXCLUDE (board_stop, alight_stop), strftime(m.op_date, '%Y%m') AS ym,
  CASE WHEN b.stop_id IS NOT NULL THEN b.canonical_stop_id ELSE CAST(m.board_stop AS VARCHAR) END AS board_stop,
  CASE WHEN a.stop_id IS NOT NULL THEN a.canonical_stop_id ELSE CAST(m.alight_stop AS VARCHAR) END AS alight_stop
FROM matched m
LEFT JOIN transfer_map b ON CAST(m.board_stop AS VARCHAR) = b.stop_id AND m.board_region = b.region_code
 AND m.board_mode = b.mode
LEFT JOIN transfer_map a ON CAST(m.alight_stop AS VARCHAR) = a.stop_id AND m.alight_region = a.region_code
 AND m.alight_mode = a.mode
""",
    "matched",
    "transfer_map",
)
cte(
    "od",
    """
SELECT ym, board_stop, board_region, board_mode, alight_stop, alight_region, alight_mode, trip_type,
  count(*) AS trips, round(avg(total_distance), 6) AS distance_avg, round(median(total_distance), 6) AS distance_median,
  round(avg(total_ride_sec), 6) AS time_avg, round(median(total_ride_sec), 6) AS time_median
FROM canonical WHERE isodow(op_date) < 6 AND op_date NOT IN (SELECT holiday_date FROM holidays) GROUP BY ALL
""",
    "canonical",
    "holidays",
)
cte(
    "od_grid",
    """
SELECT p.*, b.stop_name AS board_name, b.grid_id AS board_grid, a.stop_name AS alight_name, a.grid_id AS alight_grid
FROM od p
LEFT JOIN stops b ON p.board_stop = CAST(b.stop_id AS VARCHAR) AND p.board_region = b.region_code AND p.board_mode = b.mode
LEFT JOIN stops a ON p.alight_stop = CAST(a.stop_id AS VARCHAR) AND p.alight_region = a.region_code
 AND p.alight_mode = a.mode
""",
    "od",
    "stops",
)


# --- two months of taps, three snapshots of the stops -----------------------------------------
cte(
    "month_taps",
    """
SELECT * EXCLUDE (days) REPLACE (op_date + days AS op_date, board_ts + to_days(days) AS board_ts, alight_ts + to_days(days) AS alight_ts)
FROM (SELECT *, CASE WHEN CAST(card_id AS INTEGER) % 3 = 0 THEN 31 WHEN CAST(card_id AS INTEGER) % 3 = 2 AND day(op_date) >= 16 THEN 16 ELSE 0 END AS days FROM taps)
""",
    "taps",
)
cte(
    "stop_snapshots",
    f"""
SELECT r.* REPLACE (CASE WHEN ym >= '202402' AND stop_id % 3 = 0 THEN stop_name || ' new' ELSE stop_name END AS stop_name,
  CASE WHEN ym >= '202402' AND stop_id % 4 = 0 AND gps_x < 1000 THEN gps_x + 0.003::DOUBLE ELSE gps_x END AS gps_x), ym
FROM raw_stops r, (SELECT unnest({SNAPSHOTS}) AS ym) WHERE NOT (ym = '202402' AND stop_id % 50 = 7)
""",
    "raw_stops",
)
cte(
    "month_stops",
    """
SELECT s.* REPLACE (m.ym AS ym) FROM (SELECT DISTINCT strftime(op_date, '%Y%m') AS ym FROM month_taps) m
JOIN stop_snapshots s ON s.ym = (SELECT max(x.ym) FROM stop_snapshots x WHERE x.ym <= m.ym)
""",
    "month_taps",
    "stop_snapshots",
)
# A month is part of the card and of the region, so the views of one month serve many.
cte(
    "m_taps",
    """
SELECT * REPLACE (strftime(op_date, '%Y%m') || '|' || card_id AS card_id, region_code || '@' || strftime(op_date, '%Y%m') AS region_code)
FROM month_taps
""",
    "month_taps",
)
cte("m_raw_stops", "SELECT * EXCLUDE (ym) REPLACE (region_code || '@' || ym AS region_code) FROM month_stops", "month_stops")
cte(
    "m_transfer_map",
    """
SELECT CAST(s.stop_id AS VARCHAR) AS stop_id, s.region_code, s.mode, CAST(c.lowest AS VARCHAR) AS canonical_stop_id
FROM m_stops s JOIN (SELECT region_code, stop_name, min(stop_id) AS lowest FROM m_stops WHERE mode = 'T'
                     GROUP BY ALL HAVING count(DISTINCT stop_id) > 1) c ON s.stop_name = c.stop_name AND s.region_code = c.region_code
WHERE s.mode = 'T'
""",
    "m_stops",
)
views_with("m_", "od_grid", taps="m_taps", raw_stops="m_raw_stops", transfer_map="m_transfer_map", holidays="holidays")
