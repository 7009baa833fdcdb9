from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tapflow.operators import ordering, quality
from tapflow.plans import jobs
from tapflow.schema import PUBLISHED_OD_COLUMNS, TAP_HEADERS, TAPS_TEXT
from tapflow.session import cut, scratch_path, shared_dir
from tapflow.sources import readers, writers


def test_shared_folder_is_the_sessions(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class Bare:
    """A session without ``spark.checkpoint.dir``."""

    def __init__(self, master):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        self.sparkContext = type("Context", (), {"master": master})


def test_only_a_local_session_may_lack_the_folder():
    assert shared_dir(Bare("local[4]")).endswith("tapflow-checkpoints")
    with pytest.raises(RuntimeError):
        shared_dir(Bare("spark://host:7077"))


def test_cut_drops_lineage(spark):
    plan = cut(spark.range(10).where("id > 3"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan and "RDD" in plan


def test_read_taps(spark, tmp_path):
    head = ",".join(TAP_HEADERS)
    good = "20250106,OP,card,R0,01,,201,R1,20250106080000,0012,20250106083000,13,1,0,1,1,100.5,1800"
    bad = "20250106,OP,card,R0,01,V1,440,R1,2025010608XX00,~,,,2,0,1,1,,"
    (tmp_path / "d.csv").write_text("\n".join([head, good, bad]), encoding="utf-8")
    a, b = readers.typed_taps(readers.read_taps_csv(spark, str(tmp_path))).orderBy("txn_id").collect()
    assert (a.op_date, a.board_stop, str(a.board_ts), a.distance, a.vehicle_id) == (dt.date(2025, 1, 6), 12, "2025-01-06 08:00:00", 100.5, None)
    assert b.board_ts is None and b.board_stop is None and b.alight_stop is None and b.distance is None
    assert len(TAP_HEADERS) == len(TAPS_TEXT.fields)


def test_columns_in_another_order_stop_the_read(spark, tmp_path):
    names = list(TAP_HEADERS)
    names[3], names[4] = names[4], names[3]
    (tmp_path / "d.csv").write_text(",".join(names) + "\n" + ",".join("1" * len(names)), encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_taps_csv(spark, str(tmp_path)).collect()


def test_a_month_that_became_empty_is_cleared(spark):
    path = scratch_path(spark, "reload")
    df = spark.createDataFrame([(1, "202501"), (2, "202502"), (3, "202503")], "id int, ym string")
    writers.overwrite_partitions(df, path, ["ym"])
    writers.overwrite_partitions(df.where("id = 1"), path, ["ym"], named=["202501", "202502"])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 3]
    with pytest.raises(Exception, match="not among those named"):
        writers.overwrite_partitions(df, path, ["ym"], named=["202501"])


def test_regional_charset(spark, tmp_path):
    (tmp_path / "s.txt").write_bytes("id|이름\n1|서울역\n".encode("euc-kr"))
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    assert [tuple(r) for r in readers.read_delimited(spark, str(tmp_path), "|", "EUC-KR", schema).collect()] == [(1, "서울역")]


def test_months_prune_partitions(spark):
    path = scratch_path(spark, "months")
    df = spark.range(30).select("id", F.concat(F.lit("20250"), (F.col("id") % 3 + 1).cast("string")).alias("ym"))
    writers.write_table(df, path, ["ym"])
    got = readers.read_months(spark, path, ["202502"])
    assert got.count() == 10
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "202502" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_overwrite_partitions_is_idempotent(spark):
    path = scratch_path(spark, "idem")
    df = spark.range(20).select("id", (F.col("id") % 2).alias("p"))
    writers.overwrite_partitions(df, path, ["p"])
    one = df.where("p = 1").withColumn("id", F.col("id") + 100)
    for _ in range(2):
        writers.overwrite_partitions(one, path, ["p"])
        got = spark.read.parquet(path)
        assert got.count() == 20 and got.where("p = 1").agg(F.min("id")).first()[0] == 101
        assert got.where("p = 0").agg(F.max("id")).first()[0] == 18


def test_save_table_modes(spark):
    path = scratch_path(spark, "tbl")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writers.save_table(spark.createDataFrame([(1, "a")], "id int, t string"), name, "overwrite", path)
    writers.save_table(spark.createDataFrame([("b", 2)], "t string, id int"), name, "append")
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "a"), (2, "b")]
    writers.save_table(spark.createDataFrame([(9, "z")], "id int, t string"), name, "overwrite", path)
    assert [tuple(r) for r in spark.table(name).collect()] == [(9, "z")]


def test_export_csv(spark):
    path = scratch_path(spark, "csv")
    writers.export_csv(spark.createDataFrame([(1, None, "a,b")], "i int, n string, t string"), path, ["t", "n", "i"])
    assert [r.value for r in spark.read.text(path).collect()] == ['"a,b",\\N,1']


def test_jdbc_options():
    assert writers.jdbc_options("u", "t", None, 10000) == {"url": "u", "dbtable": "t", "batchsize": "10000"}
    assert writers.jdbc_options("u", "t", "s", 5)["dbtable"] == "s.t"


OD_DDL = """ym string, board_stop string, board_region string, board_mode string, alight_stop string, alight_region string,
  alight_mode string, trip_type string, trips bigint, distance_avg double, distance_median double, time_avg double,
  time_median double, board_name string, board_grid string, alight_name string, alight_grid string"""


def od_rows(spark, ym="202501", mode="T", trips=33):
    row = (ym, "1", "R0", mode, "2", "R0", "T", "morning", trips, 10.5, 10.0, 20.5, 20.0, "a", "CG6375150378", "b", None)
    return spark.createDataFrame([row], OD_DDL)


@pytest.fixture(scope="module")
def off(spark):
    return spark.createDataFrame([(dt.date(2025, 1, 1),)], "holiday_date date")


def test_publish(spark, off):
    path = scratch_path(spark, "pub")
    for _ in range(2):
        (row,) = jobs.publish_od(od_rows(spark), off, path).collect()
    assert list(row.asDict()) == PUBLISHED_OD_COLUMNS
    assert (row.standard_ym, str(row.daily_use_count), row.purpose_name) == ("202501", "1.5", "출근")
    assert (row.departure_grid_id, row.departure_station_geometry) == ("다사6375150378", "POINT (963751 1950378)")
    assert row.arrival_grid_id is None and row.arrival_station_geometry is None
    assert (str(row.average_elapse_time), str(row.median_distance)) == ("21", "10")
    jobs.publish_od(od_rows(spark, "202502"), off, path)
    assert spark.read.parquet(path).count() == 2


def test_publish_stops_on_a_broken_contract(spark, off):
    with pytest.raises(ValueError, match="departure_station_type"):
        jobs.publish_od(od_rows(spark, mode=None), off, scratch_path(spark, "pub"))
    twice = od_rows(spark).union(od_rows(spark, trips=5))
    with pytest.raises(ValueError, match="unique_key"):
        jobs.publish_od(twice, off, scratch_path(spark, "pub"))


def test_sample_is_repeatable_and_whole(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("string").alias("card_id"), "id")
    one = ordering.sample_cards(df, 5, 42)
    assert one.count() == 100 and one.select("card_id").distinct().count() == 5
    assert sorted(one.collect()) == sorted(ordering.sample_cards(df.repartition(7), 5, 42).collect())
    assert sorted(one.collect()) != sorted(ordering.sample_cards(df, 5, 43).collect())


def test_group_limits_run_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    for out in (ordering.dedup(df, ["k"], ["id"]), ordering.nth_row(df, "k", ["id"], 2), ordering.cards_with(df, 2, "k", ("id",))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(r.id for r in ordering.nth_row(df, "k", ["id"], 2).collect()) == [3, 4, 5]
    assert ordering.cards_with(df, 33, "k", ("id",)).count() == 66


def test_funnel_chains(spark):
    df = spark.range(10).select((F.col("id") % 4).alias("card_id"), "id")
    got = quality.funnel({"all": df, "some": df.where("id < 5"), "none": df.where("false")}, "card_id").orderBy("step").collect()
    assert [(r.stage, r.rows, r["keys"], r.pct_of_first) for r in got] == [("all", 10, 4, 100.0), ("some", 5, 4, 50.0), ("none", 0, 0, 0.0)]
