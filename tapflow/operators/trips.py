"""Legs to purpose trips."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.codes import mode_of
from ..schema import TRIP_KEY
from .clean import adults


def _picked(value: str, order: list[str], pick) -> Column:
    """First or last known value by an order that is itself known.

    A struct holding a NULL is not NULL, so both the value and the leading
    order column are tested.
    """
    known = F.col(value).isNotNull() & F.col(order[0]).isNotNull()
    return pick(F.when(known, F.col(value)), F.when(known, F.struct(*[F.col(c) for c in order])))


def purpose_trips(
    taps: DataFrame,
    *,
    keys: list[str] = TRIP_KEY,
    adults_only: bool = True,
    extra: dict[str, str] | None = None,
    tie: tuple[str, ...] = ("transfer_no",),
) -> DataFrame:
    """One row per (date, card, transaction): first boarding, last alighting,
    summed distance and time, most transfers; unfinished trips drop out.

    ``extra`` adds attributes: name -> ``first:<col>`` or ``last:<col>``.
    The group is aggregated before and after one shuffle on the trip key.
    """
    legs = adults(taps) if adults_only else taps
    legs = legs.withColumn("mode", mode_of(F.col("mode_code")))
    first, last = ["board_ts", *tie], ["alight_ts", *tie]
    aggs = [
        _picked("board_stop", first, F.min_by).alias("board_stop"),
        _picked("alight_stop", last, F.max_by).alias("alight_stop"),
        F.min("board_ts").alias("board_ts"),
        F.max("alight_ts").alias("alight_ts"),
        _picked("region_code", first, F.min_by).alias("board_region"),
        _picked("region_code", last, F.max_by).alias("alight_region"),
        _picked("mode", first, F.min_by).alias("board_mode"),
        _picked("mode", last, F.max_by).alias("alight_mode"),
        F.sum("distance").alias("total_distance"),
        F.sum("ride_sec").alias("total_ride_sec"),
        F.max("transfer_no").alias("max_transfers"),
    ]
    for name, rule in (extra or {}).items():
        side, column = rule.split(":")
        aggs.append(
            _picked(column, first, F.min_by).alias(name)
            if side == "first"
            else _picked(column, last, F.max_by).alias(name)
        )
    return legs.groupBy(*keys).agg(*aggs).where(F.col("board_ts").isNotNull() & F.col("alight_ts").isNotNull())


def purpose_trips_by_leg(taps: DataFrame, *, keys: list[str] = TRIP_KEY) -> DataFrame:
    """First leg = transfer number 0, last leg = the highest transfer number.

    A copied first or last leg multiplies its trip, and a trip whose first leg is missing keeps NULLs. No time filter.

    One shuffle: legs are dealt by the trip key, a window over the key finds sums and the highest number, and only
    first and last legs go on to be paired where they lie. Legs with an unknown key column match nothing; they are
    summed apart, before the shuffle, so that they cannot fill a task.
    """
    legs = taps.withColumn("mode", mode_of(F.col("mode_code")))
    known = legs.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    w = Window.partitionBy(*keys)
    sums = {"total_distance": F.sum("distance").over(w), "total_ride_sec": F.sum("ride_sec").over(w), "_top": F.max("transfer_no").over(w)}
    numbered = known.select(*keys, "transfer_no", "board_stop", "alight_stop", "board_ts", "alight_ts", "region_code", "mode", "distance", "ride_sec").withColumns(
        {**sums, "_turn": F.row_number().over(w.orderBy("transfer_no"))}
    )
    first = F.when(F.col("transfer_no") == 0, F.struct("board_stop", "board_ts", F.col("region_code").alias("board_region"), F.col("mode").alias("board_mode")))
    last = F.when(F.col("transfer_no") == F.col("_top"), F.struct("alight_stop", "alight_ts", F.col("region_code").alias("alight_region"), F.col("mode").alias("alight_mode")))
    # One leg at least stays, so that a trip without a first or a last one stays.
    ends = numbered.withColumns({"_first": first, "_last": last}).where("_first IS NOT NULL OR _last IS NOT NULL OR _turn = 1")
    trips = ends.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("total_distance", "total_ride_sec")], F.collect_list("_first").alias("_firsts"), F.collect_list("_last").alias("_lasts")
    )
    paired = trips.withColumn("_f", F.explode_outer("_firsts")).withColumn("_l", F.explode_outer("_lasts"))
    whole = paired.select(*keys, "_f.*", "_l.*", "total_distance", "total_ride_sec")
    unknown = legs.where(reduce(or_, [F.col(k).isNull() for k in keys]))
    loose = unknown.groupBy(*keys).agg(F.sum("distance").alias("total_distance"), F.sum("ride_sec").alias("total_ride_sec"))
    columns = ["board_stop", "alight_stop", "board_ts", "alight_ts", "board_region", "alight_region", "board_mode", "alight_mode", "total_distance", "total_ride_sec"]
    return whole.unionByName(loose, allowMissingColumns=True).select(*keys, *columns)
