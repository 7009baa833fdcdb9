"""P: projections, filters, predicates. J11 and G4 sit with the grid queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapflow.functions.codes import REGIONAL_SUBWAY_CODES

from tapflow.operators import clean
from tapflow.operators.calendar import business_days_only
from tapflow.operators.trips import purpose_trips

from .catalog import query
from .standin import holidays, raw_stops, table, taps


@query("q_p1_with_mode", "SELECT event_id, mode_code, mode FROM modes", "modes")
def p1(spark, sf):
    return clean.with_mode(taps(spark, sf), "mode_code").select("event_id", "mode_code", "mode")


def _mode_case(region: str) -> str:
    extra = REGIONAL_SUBWAY_CODES[region]
    more = f" OR mode_code IN ({', '.join(map(str, extra))})" if extra else ""
    return f"CASE WHEN mode_code BETWEEN 200 AND 299{more} THEN 'T' ELSE 'B' END AS mode_{region}"


@query(
    "q_p2_regional_modes",
    f"SELECT event_id, mode_code, {', '.join(_mode_case(r) for r in REGIONAL_SUBWAY_CODES)} FROM taps",
    "taps",
)
def p2(spark, sf):
    out = taps(spark, sf).select("event_id", "mode_code")
    for region, extra in REGIONAL_SUBWAY_CODES.items():
        out = clean.with_mode(out, "mode_code", extra, f"mode_{region}")
    return out


@query("q_p3_adults", "SELECT event_id, card_id, user_type FROM taps WHERE user_type = 1", "taps")
def p3(spark, sf):
    return clean.adults(taps(spark, sf)).select("event_id", "card_id", "user_type")


@query(
    "q_p4_business_days_only",
    """
SELECT event_id, op_date FROM taps LEFT JOIN holidays h ON op_date = h.holiday_date
WHERE isodow(op_date) < 6 AND h.holiday_date IS NULL
""",
    "taps",
    "holidays",
)
def p4(spark, sf):
    return business_days_only(taps(spark, sf).select("event_id", "op_date"), "op_date", holidays(spark))


@query("q_p5_in_hours", "SELECT event_id, board_ts FROM taps WHERE hour(board_ts) BETWEEN 6 AND 10", "taps")
def p5(spark, sf):
    return clean.in_hours(taps(spark, sf).select("event_id", "board_ts"), "board_ts", 6, 10)


@query(
    "q_p6_repair_xy",
    """
SELECT stop_id, mode,
  CASE WHEN gps_y > 100 AND gps_x < 100 THEN gps_y ELSE gps_x END AS gps_x,
  CASE WHEN gps_y > 100 AND gps_x < 100 THEN gps_x ELSE gps_y END AS gps_y,
  CAST(coalesce(gps_y > 100 AND gps_x < 100, FALSE) AS INTEGER) AS x_fixed,
  CAST(coalesce(gps_y > 100 AND gps_x < 100, FALSE) AS INTEGER) AS y_fixed,
  CAST(coalesce((gps_y > 100) <> (gps_x < 100) AND gps_x < 1000 AND gps_y < 1000, FALSE) AS INTEGER) AS xy_suspect
FROM raw_stops
""",
    "raw_stops",
)
def p6(spark, sf):
    return clean.repair_xy(raw_stops(spark, sf).select("stop_id", "mode", "gps_x", "gps_y"), "gps_x", "gps_y")


@query(
    "q_p6_repair_stats_independent",
    """
SELECT count(*) AS rows, CAST(sum(CASE WHEN gps_y > 100 THEN 1 ELSE 0 END) AS BIGINT) AS y_sum,
  CAST(sum(CASE WHEN gps_x < 100 THEN 1 ELSE 0 END) AS BIGINT) AS x_sum, 0::BIGINT AS suspect_sum FROM raw_stops
""",
    "raw_stops",
)
def p6_stats(spark, sf):
    return clean.repair_stats(clean.repair_xy(raw_stops(spark, sf), "gps_x", "gps_y", "independent"))


_ISSUES = {
    "missing": "gps_x IS NULL OR gps_y IS NULL",
    "sentinel": "gps_x >= 1000 OR gps_y >= 1000",
    "zero": "gps_x = 0 OR gps_y = 0",
    "outside": "gps_x < 124 OR gps_x > 132 OR gps_y < 33 OR gps_y > 38.9",
}


@query(
    "q_p7_coord_issues",
    " UNION ALL ".join(
        f"""SELECT '{k}' AS issue, count(*) FILTER (WHERE {t}) AS n, count(*) AS total,
  round_even(count(*) FILTER (WHERE {t}) / count(*) * 100.0, 2) AS pct FROM raw_stops"""
        for k, t in _ISSUES.items()
    ),
    "raw_stops",
)
def p7(spark, sf):
    return clean.coord_issues(raw_stops(spark, sf), "gps_x", "gps_y")


@query(
    "q_p8_strip_zeros",
    """
SELECT event_id, regexp_replace(lpad(CAST(board_stop AS VARCHAR), 8, '0'), '^0+', '') AS board_stop,
  regexp_replace(lpad(CAST(alight_stop AS VARCHAR), 8, '0'), '^0+', '') AS alight_stop FROM taps
""",
    "taps",
)
def p8(spark, sf):
    padded = taps(spark, sf).select(
        "event_id", *[F.lpad(F.col(c).cast("string"), 8, "0").alias(c) for c in ("board_stop", "alight_stop")]
    )
    return clean.strip_zeros(padded, ["board_stop", "alight_stop"])


def backwards(spark, sf):
    """Orders as trips: shipping legs that run before the order date."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("o_custkey").alias("board_stop"),
        F.col("l_suppkey").alias("alight_stop"),
        F.col("o_orderdate").alias("board_ts"),
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("alight_ts"),
    )


_BACKWARDS = """
(SELECT l_orderkey, l_linenumber, l_partkey, o_custkey AS board_stop, l_suppkey AS alight_stop,
  o_orderdate AS board_ts, CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS alight_ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


@query("q_p9_drop_inverted", f"SELECT * FROM {_BACKWARDS} WHERE NOT coalesce(board_ts > alight_ts, FALSE)")
def p9(spark, sf):
    return clean.drop_inverted(backwards(spark, sf))


@query("q_p9_inverted", f"SELECT * FROM {_BACKWARDS} WHERE alight_ts < board_ts AND board_stop <> alight_stop")
def p9_list(spark, sf):
    return clean.inverted(backwards(spark, sf))


def tap_texts(spark, sf):
    """Time texts with faults: an impossible minute, a letter, another day."""
    k = F.col("event_id") % 11
    text = F.date_format("board_ts", "yyyyMMddHHmmss")
    return taps(spark, sf).select(
        "event_id",
        F.date_format("op_date", "yyyyMMdd").alias("date_text"),
        F.when(k == 3, F.concat(F.substring(text, 1, 10), F.lit("6130")))
        .when(k == 5, F.concat(F.substring(text, 1, 8), F.lit("2A0000")))
        .when(k == 7, F.concat(F.lit("20230115"), F.substring(text, 9, 6)))
        .when(k == 9, None)
        .otherwise(text)
        .alias("ts_text"),
    )


@query(
    "q_p10_bad_timestamps",
    """
SELECT event_id, date_text, ts_text,
  coalesce(TRY_CAST(substr(ts_text, 11, 1) AS INTEGER) > 5 OR TRY_CAST(substr(ts_text, 13, 1) AS INTEGER) > 5, FALSE)
    AS bad_digit,
  try_strptime(ts_text, '%Y%m%d%H%M%S') IS NULL AS unparsable,
  coalesce(date_diff('day', CAST(try_strptime(date_text, '%Y%m%d') AS DATE),
    CAST(try_strptime(ts_text, '%Y%m%d%H%M%S') AS DATE)) NOT IN (0, 1), FALSE) AS other_day
FROM (SELECT event_id, strftime(op_date, '%Y%m%d') AS date_text,
  CASE event_id % 11 WHEN 3 THEN strftime(board_ts, '%Y%m%d%H') || '6130' WHEN 5 THEN strftime(board_ts, '%Y%m%d') || '2A0000'
    WHEN 7 THEN '20230115' || strftime(board_ts, '%H%M%S') WHEN 9 THEN NULL
    ELSE strftime(board_ts, '%Y%m%d%H%M%S') END AS ts_text FROM taps)
WHERE ts_text IS NOT NULL AND (bad_digit OR unparsable OR other_day)
""",
    "taps",
)
def p10(spark, sf):
    return clean.bad_timestamps(tap_texts(spark, sf), "ts_text", "date_text")


@query(
    "q_p11_cast_ids",
    """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE board_stop END AS board_stop,
  CAST(alight_stop AS VARCHAR) AS alight_stop FROM taps
""",
    "taps",
)
def p11(spark, sf):
    spoiled = taps(spark, sf).select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.lit("~")).otherwise(F.lpad(F.col("board_stop").cast("string"), 9, "0")).alias(
            "board_stop"
        ),
        "alight_stop",
    )
    return clean.cast_ids(spoiled, to_long=["board_stop"], to_text=["alight_stop"])


@query(
    "q_p12_drop_nulls",
    """
SELECT event_id, vehicle_id, alight_stop, 'alight' AS rule FROM taps WHERE alight_stop IS NOT NULL
UNION ALL SELECT event_id, vehicle_id, alight_stop, 'any' FROM taps
WHERE alight_stop IS NOT NULL AND vehicle_id IS NOT NULL
""",
    "taps",
)
def p12(spark, sf):
    df = taps(spark, sf).select("event_id", "vehicle_id", "alight_stop")
    one = clean.drop_nulls(df, ["alight_stop"]).withColumn("rule", F.lit("alight"))
    return one.unionByName(clean.drop_nulls(df).withColumn("rule", F.lit("any")))


@query(
    "q_p13_publish_measures",
    """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_tax * 60) AS BIGINT) AS l_tax,
  CAST(trunc(l_quantity) AS BIGINT) AS l_quantity, CAST(round_even(l_extendedprice, 0) AS BIGINT) AS l_extendedprice
FROM lineitem
""",
)
def p13(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_quantity", "l_extendedprice")
    return clean.publish_measures(lines, {"l_tax": "seconds", "l_quantity": "whole", "l_extendedprice": "round"})


@query(
    "q_p15_keep_cards",
    "SELECT event_id, card_id FROM taps WHERE card_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 5000)",
    "taps",
)
def p15(spark, sf):
    rich = table(spark, sf, "customer").where(F.col("c_acctbal") > 5000)
    cards = rich.select(F.col("c_custkey").cast("string").alias("card_id"))
    return clean.keep_cards(taps(spark, sf).select("event_id", "card_id"), cards)


_ECONOMY = "(SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')"


@query(
    "q_p16_touching",
    " UNION ALL ".join(
        f"SELECT op_date, card_id, txn_id, board_stop, alight_stop, '{how}' AS how FROM trips WHERE {test}"
        for how, test in {
            "either": f"board_stop IN {_ECONOMY} OR alight_stop IN {_ECONOMY}",
            "both": f"board_stop IN {_ECONOMY} AND alight_stop IN {_ECONOMY}",
        }.items()
    ),
    "trips",
)
def p16(spark, sf):
    trips = purpose_trips(taps(spark, sf)).select("op_date", "card_id", "txn_id", "board_stop", "alight_stop")
    stops = table(spark, sf, "part").where(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("stop_id"))
    either = clean.touching(trips, stops, "either").withColumn("how", F.lit("either"))
    return either.unionByName(clean.touching(trips, stops, "both").withColumn("how", F.lit("both")))


@query(
    "q_p17_negative_values",
    """
SELECT 'c_acctbal' AS column_name, count(*) FILTER (WHERE c_acctbal < 0) AS negatives, count(*) AS total FROM customer
UNION ALL SELECT 'c_custkey', count(*) FILTER (WHERE c_custkey < 0), count(*) FROM customer
""",
)
def p17(spark, sf):
    return clean.negative_values(table(spark, sf, "customer"), ["c_acctbal", "c_custkey"])


@query(
    "q_p17_negative_rows",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_nationkey < 0",
)
def p17_rows(spark, sf):
    return clean.negative_rows(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"]).select(
        "c_custkey", "c_name", "c_acctbal"
    )


@query(
    "q_p18_select_buildings",
    "SELECT p_partkey, p_name, p_type FROM part WHERE contains(p_name, 'ring') AND p_type IN ('SMALL', 'ECONOMY')",
)
def p18(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return clean.select_buildings(parts, "p_name", "ring", "p_type", ["SMALL", "ECONOMY"])
