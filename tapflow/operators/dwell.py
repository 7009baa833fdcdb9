"""Dwell time between a card's trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import half_even
from ..functions.times import seconds_between
from .anchors import with_cells
from .clean import drop_inverted
from .enrich import commuter_trips, enrich_stops
from .ordering import with_next_trip, with_prev_trip

# Shortest and longest dwell, in seconds.
MIN_DWELL = 300.0
MAX_DWELL = 86400.0


def activity(alight: Column, board: Column, home: Column, work: Column) -> Column:
    """``live``, ``work``, ``play`` or ``other`` from the cells at both ends of
    a stay; an unknown cell never makes a test true."""
    away = (alight != home) & (alight != work) & (board != home) & (board != work)
    return (
        F.when((alight == home) & (board == home), "live")
        .when((alight == work) & (board == work), "work")
        .when(away, "play")
        .otherwise("other")
    )


def _halves(df: DataFrame, first: tuple[str, str, str], second: tuple[str, str, str], keep: list[str]) -> DataFrame:
    """Half of a stay for each of the two stops, one person each."""

    def end(cols: tuple[str, str, str]) -> Column:
        stop, region, mode = cols
        return F.struct(
            F.col(stop).alias("stop_id"), F.col(region).alias("region_code"), F.col(mode).alias("mode")
        )

    return df.select(
        *keep,
        F.inline(F.array(end(first), end(second))),
        (F.col("_stay") / 2).alias("minutes"),
        F.lit(1.0).alias("persons"),
    )


def dwell_events(trips: DataFrame, anchor_cells: DataFrame, stops: DataFrame, parts: int | None = None) -> DataFrame:
    """Stays of commuters between two trips, 5 minutes to 1 day, by activity."""
    own = with_cells(commuter_trips(trips, anchor_cells), stops)
    following = with_next_trip(own, ["board_cell"], parts)
    gap = seconds_between(F.col("alight_ts"), F.col("next_board_ts"))
    stays = (
        following.withColumn("_gap", gap)
        .where(F.col("next_board_stop").isNotNull() & F.col("alight_stop").isNotNull())
        .where(F.col("_gap").between(MIN_DWELL, MAX_DWELL))
        .withColumn("_stay", F.col("_gap") / 60)
        .withColumn(
            "duration_type",
            activity(F.col("alight_cell"), F.col("next_board_cell"), F.col("home_cell"), F.col("work_cell")),
        )
    )
    return _halves(
        stays,
        ("alight_stop", "alight_region", "alight_mode"),
        ("next_board_stop", "next_board_region", "next_board_mode"),
        ["op_date", "card_id", "duration_type"],
    )


def dwell_events_simple(trips: DataFrame, min_minutes: float = 5.0, parts: int | None = None) -> DataFrame:
    """Half stays of more than 5 minutes before each trip; no activity type."""
    timed = drop_inverted(trips.where(F.col("board_ts").isNotNull() & F.col("alight_ts").isNotNull()))
    previous = with_prev_trip(timed, parts)
    stays = previous.withColumn(
        "_stay", seconds_between(F.col("prev_alight_ts"), F.col("board_ts")) / 60
    ).where(F.col("_stay").isNotNull())
    halves = _halves(
        stays,
        ("board_stop", "board_region", "board_mode"),
        ("prev_alight_stop", "prev_alight_region", "prev_alight_mode"),
        ["card_id"],
    )
    return halves.where(F.col("minutes") > min_minutes)


STOP_ATTRS = ["stop_name", "legal_dong", "gps_x", "gps_y"]


def _named(stats: DataFrame, stops: DataFrame) -> DataFrame:
    keyed = stats.withColumnsRenamed({"stop_id": "at_stop", "region_code": "at_region", "mode": "at_mode"})
    return enrich_stops(keyed, stops, STOP_ATTRS, ("at",)).withColumnsRenamed(
        {
            "at_stop": "stop_id",
            "at_region": "region_code",
            "at_mode": "mode",
            **{f"at_{c}": c for c in STOP_ATTRS},
        }
    )


def dwell_stats(events: DataFrame, stops: DataFrame) -> DataFrame:
    """Per day, stop and activity: total, persons, mean and median minutes.

    Stop attributes are looked up after the aggregate, on far fewer rows.
    Dwell lies in [5 min, 1 day] at whole seconds, which bounds the median's
    value map.
    """
    stats = events.groupBy("op_date", "stop_id", "region_code", "mode", "duration_type").agg(
        F.sum("minutes").alias("total_minutes"),
        F.sum("persons").alias("total_persons"),
        F.avg("minutes").alias("minutes_avg"),
        F.median("minutes").alias("minutes_median"),
    )
    return _named(stats, stops)


def two_digits(value: Column) -> Column:
    """Half-even; settled at six digits first, so that the order of addition
    cannot tip a tie."""
    return half_even(F.round(value, 6), 2)


def dwell_stats_simple(events: DataFrame, stops: DataFrame) -> DataFrame:
    stats = (
        events.where(F.col("stop_id").isNotNull() & F.col("region_code").isNotNull() & F.col("mode").isNotNull())
        .groupBy("stop_id", "region_code", "mode")
        .agg(
            F.sum("persons").alias("duration_count"),
            two_digits(F.sum("minutes")).alias("duration_total_min"),
            two_digits(F.avg("minutes")).alias("duration_mean_min"),
            two_digits(F.median("minutes")).alias("duration_median_min"),
        )
    )
    return _named(stats, stops)
