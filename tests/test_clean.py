from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tapflow.functions.numbers import half_even, joined_key
from tapflow.operators import clean, quality
from tapflow.schema import Contract

XY = [(1, 127.0, 37.5), (2, 37.5, 127.0), (3, 127.0, 127.1), (4, 99999.0, 99999.0), (5, None, 37.5)]


def repaired(spark, mode):
    df = spark.createDataFrame(XY, "id int, x double, y double")
    return {r.id: r for r in clean.repair_xy(df, "x", "y", mode).collect()}


def test_paired_repair(spark):
    got = repaired(spark, "paired")
    assert (got[2].x, got[2].y, got[2].x_fixed, got[2].y_fixed) == (127.0, 37.5, 1, 1)
    assert (got[3].x, got[3].y, got[3].xy_suspect, got[3].x_fixed) == (127.0, 127.1, 1, 0)
    assert (got[1].x, got[1].y, got[1].xy_suspect) == (127.0, 37.5, 0)
    assert got[4].xy_suspect == 0 and got[5].x is None and got[5].xy_suspect == 0


def test_independent_repair_doubles_the_good_value(spark):
    got = repaired(spark, "independent")
    assert (got[2].x, got[2].y) == (127.0, 37.5)
    assert (got[3].x, got[3].y, got[3].y_fixed, got[3].x_fixed) == (127.0, 127.0, 1, 0)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        clean.repair_xy(spark.createDataFrame(XY, "id int, x double, y double"), "x", "y", "both")


def test_build_stops(spark):
    rows = [(i, "R0", "T", f"s{i}", "1", x, y) for i, x, y in XY] + [(1, "R0", "T", "s9", "1", 127.9, 37.9)]
    df = spark.createDataFrame(rows, "stop_id int, region_code string, mode string, stop_name string, legal_dong string, gps_x double, gps_y double")
    got = {r.stop_id: r for r in clean.build_stops(df).collect()}
    assert sorted(got) == [1, 2, 3]
    assert got[1].stop_name == "s1" and got[1].grid_id == got[2].grid_id
    assert got[3].x_5179 is None and got[3].grid_id is None and got[3].xy_suspect == 1


def test_cast_ids(spark):
    df = spark.createDataFrame([("0012", 7), ("x1", None), (None, 3)], "a string, b bigint")
    assert [tuple(r) for r in clean.cast_ids(df, ["a"], ["b"]).collect()] == [(12, "7"), (None, None), (None, "3")]


def test_strip_zeros(spark):
    df = spark.createDataFrame([("0012",), ("10",), ("000",)], "a string")
    assert [r.a for r in clean.strip_zeros(df, ["a"]).collect()] == ["12", "10", ""]


def test_bad_timestamps(spark):
    rows = ["20250106080000", "20250106086000", "20250106080061", "2025010608XX00", "20250107003000", "20250109080000", None]
    df = spark.createDataFrame([(i, t, "20250106") for i, t in enumerate(rows)], "i int, ts string, d string")
    got = {r.i: (r.bad_digit, r.unparsable, r.other_day) for r in clean.bad_timestamps(df, "ts", "d").collect()}
    assert got == {1: (True, True, False), 2: (True, True, False), 3: (False, True, False), 5: (False, False, True)}


def test_publish_measures(spark):
    df = spark.createDataFrame([(1.99, 2.9, 2.5), (0.51, -2.9, 3.5)], "a double, b double, c double")
    got = clean.publish_measures(df, {"a": "seconds", "b": "whole", "c": "round"}).collect()
    assert [tuple(r) for r in got] == [(119, 2, 2), (30, -2, 4)]


def test_half_even_is_binary(spark):
    df = spark.createDataFrame([(0.575,), (0.125,), (2.5,), (0.476,)], "v double")
    got = [r[0] for r in df.select(half_even(F.col("v"), 2)).collect()]
    assert got == [0.57, 0.12, 2.5, 0.48]


def test_joined_key(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "x string, y int")
    assert [r[0] for r in df.select(joined_key([F.col("x"), F.col("y")])).collect()] == ["a_1", None]
    with pytest.raises(ValueError):
        joined_key([])


def test_distance_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 99.99, 100, 1000, 5000, 1000000)], "d double")
    got = [r.b for r in df.select(quality.bin_of(F.col("d")).alias("b")).collect()]
    assert got == ["0~100", "0~100", "100~200", "1000~2000", "5000~", None]
    filled = {r.bin: r.n for r in quality.bin_counts(df, "d").collect()}
    assert len(filled) == 14 and filled["200~300"] == 0 and filled[None] == 1


def test_contract(spark):
    rows = [("202501", "a", 1.0), ("202501", "a", 99.96), ("2025010", None, 100.0)]
    df = spark.createDataFrame(rows, "ym string, id string, v double")
    rules = Contract(lengths={"ym": 6}, numerics={"v": (3, 1)}, required=("id",), key=("ym", "id"))
    got = {(r.rule, r.column_name): r.violations for r in quality.validate_target(df, rules).collect()}
    assert got == {("not_null", "id"): 1, ("length", "ym"): 1, ("numeric", "v"): 2, ("unique_key", "ym,id"): 1}


def test_null_profile_and_rates(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", 2)], "g string, v int")
    assert {r.column_name: (r.nulls, r.null_pct) for r in quality.null_profile(df).collect()} == {"g": (0, 0.0), "v": (1, 33.33)}
    assert [tuple(r) for r in quality.null_rate_by(df, "g", "v").collect()] == [("a", 0.5, 2)]


def test_resample_keeps_empty_bins(spark):
    from tests.conftest import at

    df = spark.createDataFrame([(at("2025-01-06 08:10:00"),), (at("2025-01-06 09:40:00"),), (None,)], "ts timestamp_ntz")
    got = [(str(r.bin)[11:16], r.n) for r in quality.resample_counts(df, "ts").orderBy("bin").collect()]
    assert got == [("08:00", 1), ("08:30", 0), ("09:00", 0), ("09:30", 1)]


def test_duplicate_rows_treat_null_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert quality.duplicate_rows(df, ["a", "b"]).count() == 2


def test_column_profile(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("", None), (None, 4.0)], "t string, v double")
    got = {r.column_name: r for r in quality.column_profile(df).collect()}
    t, v = got["t"], got["v"]
    assert (t.total_count, t.unique_count, t.null_count, t.blank_count, t.top_value, t.rare_value) == (3, 3, 1, 1, "", "")
    assert (v.mean, v.std, v.min, v.q1, v.median, v.q3, v.max) == (2.333, 1.528, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert got["t"].mean is None


def test_time_texts_are_made_once_and_not_for_every_use(spark):
    raw = spark.sql("SELECT timestamp_ntz'2024-01-05 08:00:00' + make_dt_interval(id) AS at FROM range(3)")
    texts = raw.select(F.date_format("at", "yyyyMMddHHmmss").alias("ts"), F.lit("20240105").alias("d"))
    found = clean.bad_timestamps(texts, "ts", "d").agg(F.count_if("bad_digit"), F.count_if("unparsable"), F.count_if("other_day"))
    assert tuple(found.first()) == (0, 0, 1)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("date_format") == 1
