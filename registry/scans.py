"""S: scans, sources, sinks. Each sink is written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tapflow.functions.times import year_month
from tapflow.operators.calendar import month_span
from tapflow.operators.quality import validate_target
from tapflow.schema import TAP_HEADERS, TAPS_TEXT, Contract
from tapflow.session import scratch_path
from tapflow.sources import readers, writers

from .catalog import query
from .standin import raw_stops, table, taps

TAP_COLUMNS = [f.name for f in TAPS_TEXT.fields]
TAPS_SELECT = ", ".join(
    "CAST(txn_id AS VARCHAR) AS txn_id" if c == "txn_id" else c for c in TAP_COLUMNS
)


def tap_extract(spark, sf):
    """Taps as an extract file spells them: text ids and times."""
    df = taps(spark, sf)
    text = {
        "op_date": F.date_format("op_date", "yyyyMMdd"),
        "board_ts": F.date_format("board_ts", "yyyyMMddHHmmss"),
        "alight_ts": F.date_format("alight_ts", "yyyyMMddHHmmss"),
        "board_stop": F.lpad(F.col("board_stop").cast("string"), 10, "0"),
        "alight_stop": F.lpad(F.col("alight_stop").cast("string"), 10, "0"),
        "txn_id": F.col("txn_id").cast("string"),
    }
    return df.withColumns(text).select(*TAP_COLUMNS)


@query("q_s1_read_taps_csv", f"SELECT {TAPS_SELECT} FROM taps", "taps")
def s1(spark, sf):
    path = scratch_path(spark, "taps-csv")
    headed = tap_extract(spark, sf).toDF(*TAP_HEADERS)
    headed.write.option("header", True).csv(path)
    return readers.typed_taps(readers.read_taps_csv(spark, path))


@query(
    "q_s2_read_delimited",
    "SELECT stop_id, region_code, mode, '정류장 ' || stop_name AS stop_name FROM raw_stops",
    "raw_stops",
)
def s2(spark, sf):
    path = scratch_path(spark, "stops-txt")
    named = raw_stops(spark, sf).select(
        "stop_id", "region_code", "mode", F.concat(F.lit("정류장 "), "stop_name").alias("stop_name")
    )
    readers.allow_encoding(spark, "EUC-KR")
    named.write.option("header", True).option("sep", "|").option("encoding", "EUC-KR").csv(path)
    schema = T.StructType(
        [
            T.StructField("stop_id", T.LongType()),
            T.StructField("region_code", T.StringType()),
            T.StructField("mode", T.StringType()),
            T.StructField("stop_name", T.StringType()),
        ]
    )
    return readers.read_delimited(spark, path, "|", "EUC-KR", schema)


@query(
    "q_s3_read_months",
    """
SELECT strftime(o_orderdate, '%Y%m') AS ym, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1
""",
)
def s3(spark, sf):
    path = scratch_path(spark, "orders-months")
    orders = table(spark, sf, "orders").withColumn("ym", year_month(F.to_date("o_orderdate")))
    writers.write_table(orders, path, ["ym"])
    months = readers.read_months(spark, path)
    return months.groupBy("ym").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("q_s4_ingest_days", f"SELECT {TAPS_SELECT}, strftime(op_date, '%Y%m') AS ym FROM taps", "taps")
def s4(spark, sf):
    days, out = scratch_path(spark, "daily-csv"), scratch_path(spark, "monthly")
    extract = tap_extract(spark, sf)
    extract.withColumn("day", F.col("op_date")).withColumnsRenamed({name: header for header, name in TAP_HEADERS.items()}).write.partitionBy("day").option("header", True).csv(days)
    return writers.ingest_days(spark, f"{days}/day=*", out).withColumn("ym", F.col("ym").cast("string"))


@query(
    "q_s5_months_between",
    """
SELECT strftime(m, '%Y%m') AS ym FROM (SELECT unnest(generate_series(
  date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)
""",
)
def s5(spark, sf):
    span = table(spark, sf, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi")
    )
    return month_span(span, F.col("lo"), F.col("hi"))


@query("q_s6_write_table", "SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_returnflag FROM lineitem")
def s6(spark, sf):
    path = scratch_path(spark, "lineitem")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag"
    )
    writers.write_table(lines, path, ["l_returnflag"])
    return spark.read.parquet(path)


@query(
    "q_s7_overwrite_partitions",
    """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS price
FROM orders
""",
)
def s7(spark, sf):
    path = scratch_path(spark, "orders-status")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    changed = orders.where(F.col("o_orderstatus") == "F").withColumn("price", F.col("price") * 2)
    writers.overwrite_partitions(orders, path, ["o_orderstatus"])
    for _ in range(2):
        writers.overwrite_partitions(changed, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query(
    "q_s8_save_table",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def s8(spark, sf):
    path = scratch_path(spark, "parties")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    writers.save_table(customers, name, "overwrite", path)
    writers.save_table(suppliers, name, "append")
    return spark.table(name)


@query(
    "q_s9_export_csv",
    r"""
SELECT strftime(op_date, '%Y-%m-%d') || ',' || card_id || ',' || transfer_no || ',' || board_stop || ','
  || coalesce(CAST(alight_stop AS VARCHAR), '\N') || ',' || coalesce(vehicle_id, '\N') AS line FROM taps
""",
    "taps",
)
def s9(spark, sf):
    path = scratch_path(spark, "export")
    cols = ["op_date", "card_id", "transfer_no", "board_stop", "alight_stop", "vehicle_id"]
    writers.export_csv(taps(spark, sf), path, cols)
    return spark.read.text(path).withColumnRenamed("value", "line")


TAP_CONTRACT = Contract(
    lengths={"card_id": 2, "route_id": 2, "region_code": 2},
    numerics={"distance": (4, 0), "ride_sec": (4, 1)},
    required=("card_id", "vehicle_id", "alight_stop"),
    key=("op_date", "card_id", "txn_id"),
)


@query(
    "q_s13_validate_target",
    """
SELECT 'not_null' AS rule, 'card_id' AS column_name, count(*) FILTER (WHERE card_id IS NULL) AS violations FROM taps
UNION ALL SELECT 'not_null', 'vehicle_id', count(*) FILTER (WHERE vehicle_id IS NULL) FROM taps
UNION ALL SELECT 'not_null', 'alight_stop', count(*) FILTER (WHERE alight_stop IS NULL) FROM taps
UNION ALL SELECT 'length', 'card_id', count(*) FILTER (WHERE length(card_id) > 2) FROM taps
UNION ALL SELECT 'length', 'route_id', count(*) FILTER (WHERE length(route_id) > 2) FROM taps
UNION ALL SELECT 'length', 'region_code', count(*) FILTER (WHERE length(region_code) > 2) FROM taps
UNION ALL SELECT 'numeric', 'distance', count(*) FILTER (WHERE abs(round(distance, 0)) >= 10000) FROM taps
UNION ALL SELECT 'numeric', 'ride_sec', count(*) FILTER (WHERE abs(round(ride_sec, 1)) >= 1000) FROM taps
UNION ALL SELECT 'unique_key', 'op_date,card_id,txn_id', count(*)
  FROM (SELECT 1 FROM taps GROUP BY op_date, card_id, txn_id HAVING count(*) > 1)
""",
    "taps",
)
def s13(spark, sf):
    return validate_target(taps(spark, sf), TAP_CONTRACT)


@query(
    "q_s14_partition_layout",
    """
SELECT date_trunc('month', CAST(l_shipdate AS DATE))::DATE AS month_start, count(*) AS n,
  round(sum(l_quantity), 6) AS qty FROM lineitem GROUP BY 1
""",
)
def s14(spark, sf):
    path = scratch_path(spark, "by-month")
    lines = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("ship"), "l_quantity")
    writers.write_table(writers.month_of_date_layout(lines, "ship"), path, ["month_start"])
    return (
        spark.read.parquet(path)
        .groupBy("month_start")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 6).alias("qty"))
    )
