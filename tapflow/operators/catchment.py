"""Trips around a neighbourhood: round trips, return gaps, commuter rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import planar_distance
from ..session import grown
from .ordering import cards_with

# Inclusive hours of the first arrival and the second departure.
ARRIVE_HOURS = (7, 10)
RETURN_HOURS = (17, 20)

CARD = ["card_id"]


def return_gap(df: DataFrame, key: list[str] = CARD) -> DataFrame:
    """Metres between the first alighting and the second boarding of two-trip
    cards. Needs ``alight_x_5179`` and so on at both ends."""
    two = cards_with(df, 2, key)

    def of(trip: int, col: str) -> Column:
        return F.max(F.when(F.col("trip_no") == trip, F.col(col)))

    ends = two.groupBy(*key).agg(
        of(1, "alight_x_5179").alias("_x1"),
        of(1, "alight_y_5179").alias("_y1"),
        of(2, "board_x_5179").alias("_x2"),
        of(2, "board_y_5179").alias("_y2"),
    )
    gap = planar_distance(F.col("_x1"), F.col("_y1"), F.col("_x2"), F.col("_y2"))
    return ends.select(*key, F.round(gap, 2).alias("distance"))


def _clock_in(ts: str, hours: tuple[int, int]) -> Column:
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), F.col(ts))
    return clock.between(hours[0] * 3600, hours[1] * 3600)


def two_trip_days(df: DataFrame, stops: DataFrame, key: list[str] = CARD) -> DataFrame:
    """Trips of two-trip cards with two flags per card: ``returning`` leaves
    from the stop set and comes back into it; ``commuting`` arrives in the
    morning and departs again in the evening.

    The rows are hashed by card once; the flags are windows over the same key.
    """
    listed = stops.select("stop_id").distinct()
    board = listed.select(F.col("stop_id").alias("board_stop"), F.lit(True).alias("_at_board"))
    alight = listed.select(F.col("stop_id").alias("alight_stop"), F.lit(True).alias("_at_alight"))
    two = cards_with(df, 2, key)
    marked = two.join(grown(board), "board_stop", "left").join(grown(alight), "alight_stop", "left")
    per_card = Window.partitionBy(*key)

    def holds(trip: int, test: Column) -> Column:
        return F.max(F.coalesce((F.col("trip_no") == trip) & test, F.lit(False))).over(per_card)

    return marked.withColumns(
        {
            "returning": holds(1, F.col("_at_board")) & holds(2, F.col("_at_alight")),
            "commuting": holds(1, _clock_in("alight_ts", ARRIVE_HOURS)) & holds(2, _clock_in("board_ts", RETURN_HOURS)),
        }
    ).select(*two.columns, "returning", "commuting")


def round_trip_commuters(df: DataFrame, stops: DataFrame, key: list[str] = CARD) -> DataFrame:
    """Trips of cards that make a commuting round trip from the stop set."""
    days = two_trip_days(df, stops, key)
    return days.where(F.col("returning") & F.col("commuting")).drop("returning", "commuting")


def mean_ride(df: DataFrame, stops: DataFrame) -> DataFrame:
    """Mean time and distance of trips that start in, and end in, the stop set."""
    listed = stops.select("stop_id").distinct()
    parts = []
    for end in ("board", "alight"):
        here = df.join(grown(listed.withColumnRenamed("stop_id", f"{end}_stop")), f"{end}_stop", "left_semi")
        parts.append(
            here.agg(
                F.round(F.avg("total_ride_sec"), 2).alias("mean_sec"),
                F.round(F.avg("total_distance"), 2).alias("mean_m"),
                F.count(F.lit(1)).alias("trips"),
            ).select(F.lit(end).alias("end"), "*")
        )
    return parts[0].unionByName(parts[1])
