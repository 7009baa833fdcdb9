"""Commuting origin-destination tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import hour_in
from ..schema import OD_KEY
from ..session import grown
from .anchors import AM_HOURS, MIN_CONFIDENCE, PM_HOURS
from .calendar import business_days_only
from .enrich import canonical_ids, canonicalise_stops, commuter_trips, enrich_stops
from .quantiles import exact_quantiles

# Trip type -> (hours of both ends, anchor at the start, anchor at the end).
COMMUTES = {
    "morning": (AM_HOURS, "residence", "office"),
    "evening": (PM_HOURS, "office", "residence"),
}


def match_commutes(trips: DataFrame, anchors: DataFrame, min_conf: float = MIN_CONFIDENCE) -> DataFrame:
    """Trips between a card's home and work stops in commuting hours.

    One read of the trips: the hours decide the direction before any
    shuffle, and each end then needs one semi join on the full stop key.
    """
    kinds = [
        F.when(
            hour_in(F.col("board_ts"), *hours) & hour_in(F.col("alight_ts"), *hours),
            F.struct(F.lit(name).alias("trip_type"), F.lit(start).alias("_from"), F.lit(end).alias("_to")),
        )
        for name, (hours, start, end) in COMMUTES.items()
    ]
    timed = trips.select("*", F.inline(F.array_compact(F.array(*kinds))))
    sure = anchors.where(F.col("confidence") >= min_conf)

    def stops_at(end: str, kind: str) -> DataFrame:
        return sure.select(
            "card_id",
            F.col("location_type").alias(kind),
            F.col("stop_id").alias(f"{end}_stop"),
            F.col("region_code").alias(f"{end}_region"),
            F.col("transport_type").alias(f"{end}_mode"),
        )

    for end, kind in (("board", "_from"), ("alight", "_to")):
        timed = timed.join(
            grown(stops_at(end, kind)), ["card_id", kind, f"{end}_stop", f"{end}_region", f"{end}_mode"], "left_semi"
        )
    return timed.select(*trips.columns, "trip_type")


def od_measures(distance: str = "total_distance", time: str = "total_ride_sec") -> list[Column]:
    """Count, mean and exact median.

    A median keeps a value-to-count map per group. Metres and seconds of a
    day's trip are whole numbers, so the map of the busiest pair is bounded by
    those ranges, not by its trips, and it is combined before the shuffle.
    """
    return [
        F.count(F.lit(1)).alias("trips"),
        F.avg(distance).alias("distance_avg"),
        F.median(distance).alias("distance_median"),
        F.avg(time).alias("time_avg"),
        F.median(time).alias("time_median"),
    ]


def commute_od(
    trips: DataFrame,
    anchors: DataFrame,
    transfer_map: DataFrame,
    holidays: DataFrame,
    min_conf: float = MIN_CONFIDENCE,
    extra_keys: tuple[str, ...] = (),
) -> DataFrame:
    """Commuting OD on business days, transfer stations merged (by the map of the month where it holds ``extra_keys``)."""
    days = business_days_only(trips, "op_date", holidays)
    months = tuple(k for k in extra_keys if k in transfer_map.columns)
    matched = canonicalise_stops(match_commutes(days, anchors, min_conf), transfer_map, months)
    return matched.groupBy(*extra_keys, *OD_KEY, "trip_type").agg(*od_measures())


def od_monitor(matched: DataFrame, keys: tuple[str, ...] = ("ym",)) -> DataFrame:
    return matched.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("monthly_od_cnt"), F.countDistinct("card_id").alias("monthly_od_card_cnt")
    )


CELL_ATTRS = {
    "stop": "station_id",
    "stop_name": "station_name",
    "mode": "station_type",
    "legal_dong": "station_admin",
    "gps_x": "station_x",
    "gps_y": "station_y",
}


def cell_commutes(trips: DataFrame, anchor_cells: DataFrame, stops: DataFrame) -> DataFrame:
    """OD between home and work cells in both directions (``direction``) with names, admin codes and coordinates.

    ``morning`` travels from home to work, ``evening`` back; all attributes are reported by role. No hour filter.
    Trips and stops are read once: a trip gives a row for each direction that it fits.
    """
    tagged = enrich_stops(trips, stops.withColumnRenamed("cell_id", "cell"), ["cell", *[c for c in CELL_ATTRS if c not in ("stop", "mode")]])
    joined = commuter_trips(tagged, anchor_cells)

    def way(direction: str, live: str, work: str) -> Column:
        fits = (F.col(f"{live}_cell") == F.col("home_cell")) & (F.col(f"{work}_cell") == F.col("work_cell"))
        roles = [F.col(f"{end}_{c}").alias(f"{role}_{name}") for c, name in CELL_ATTRS.items() for role, end in (("live", live), ("work", work))]
        return F.when(fits, F.struct(F.lit(direction).alias("direction"), *roles))

    ways = F.array_compact(F.array(way("morning", "board", "alight"), way("evening", "alight", "board")))
    found = joined.select("total_distance", "total_ride_sec", F.inline(ways))
    keys = [c for c in found.columns if c not in ("total_distance", "total_ride_sec")]
    return found.groupBy(*keys).agg(*od_measures()).withColumnRenamed("trips", "commute_count")


def cell_commute_od(trips: DataFrame, anchor_cells: DataFrame, stops: DataFrame, direction: str) -> DataFrame:
    """One direction of ``cell_commutes``."""
    return cell_commutes(trips, anchor_cells, stops).where(F.col("direction") == direction).drop("direction")


PAIR_COLUMNS = ["stop", "region", "mode", "stop_name"]


def pair_stats(tagged: DataFrame, anchor_cells: DataFrame) -> DataFrame:
    """To-work and to-home use of each home-work stop pair of a card.

    Needs cells and stop names at both ends. One conditional aggregate gives
    what a FULL OUTER join of two aggregates gives; a side without trips
    stays NULL. Pairs with an unknown part drop out.
    """
    own = commuter_trips(tagged, anchor_cells)

    def pair(direction: str, live: str, work: str) -> Column:
        fields = [F.col(f"{live}_{c}").alias(f"live_{c}") for c in PAIR_COLUMNS]
        fields += [F.col(f"{work}_{c}").alias(f"work_{c}") for c in PAIR_COLUMNS]
        test = (F.col(f"{live}_cell") == F.col("home_cell")) & (F.col(f"{work}_cell") == F.col("work_cell"))
        return F.when(test, F.struct(F.lit(direction).alias("dir"), *fields))

    both = F.array_compact(F.array(pair("work", "board", "alight"), pair("live", "alight", "board")))
    rows = own.select("card_id", "total_ride_sec", "total_distance", F.inline(both))
    keys = ["card_id", *[f"{role}_{c}" for role in ("live", "work") for c in PAIR_COLUMNS]]
    rows = rows.na.drop(subset=keys)
    aggs = []
    for way in ("work", "live"):
        here = F.col("dir") == way
        n = F.count(F.when(here, 1))
        aggs += [
            F.when(n > 0, n).alias(f"to_{way}_frequency"),
            F.avg(F.when(here, F.col("total_ride_sec"))).alias(f"to_{way}_time"),
            F.avg(F.when(here, F.col("total_distance"))).alias(f"to_{way}_distance"),
        ]
    return rows.groupBy(*keys).agg(*aggs)


def strict_cells(tagged: DataFrame) -> DataFrame:
    """Home and work by agreement of the *lowest* modal cells, hours [6,12) and
    [16,24), unknown cells ignored; any disagreement drops the card."""
    hits = []
    for win, end, (lo, hi) in (
        ("am_dep", "board", (6, 11)),
        ("pm_arr", "alight", (16, 23)),
        ("am_arr", "alight", (6, 11)),
        ("pm_dep", "board", (16, 23)),
    ):
        use = hour_in(F.col(f"{end}_ts"), lo, hi) & F.col(f"{end}_cell").isNotNull()
        hits.append(F.when(use, F.struct(F.lit(win).alias("win"), F.col(f"{end}_cell").alias("cell"))))
    counts = (
        tagged.select("card_id", F.inline(F.array_compact(F.array(*hits))))
        .groupBy("card_id", "win", "cell")
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    best = F.struct((-F.col("freq")).alias("neg"), F.col("cell"))
    modes = counts.groupBy("card_id").agg(
        *[
            F.min(F.when(F.col("win") == win, best))["cell"].alias(win)
            for win in ("am_dep", "pm_arr", "am_arr", "pm_dep")
        ]
    )
    return modes.where((F.col("am_dep") == F.col("pm_arr")) & (F.col("am_arr") == F.col("pm_dep"))).select(
        "card_id", F.col("am_dep").alias("home_cell"), F.col("am_arr").alias("work_cell")
    )


def card_commute_pairs(trips: DataFrame, stops: DataFrame) -> DataFrame:
    """Per-card commuting pattern: strict mode agreement, then pair use."""
    dim = stops.withColumnRenamed("cell_id", "cell")
    tagged = enrich_stops(trips, dim, ["cell", "stop_name"])
    return pair_stats(tagged, strict_cells(tagged))


def od_hourly(trips: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Daily, hourly OD cube by boarding hour.

    Two grains: cards are first made distinct per cell of the cube, as rows without measures; trips and these rows then
    go through one aggregate. Its partial maps of whole metres, seconds and transfers are made per cell, not per card.
    """
    keys = ["op_date", "hour", *OD_KEY, *extra_keys]
    timed = trips.withColumn("hour", F.hour("board_ts"))
    cards = timed.where(F.col("card_id").isNotNull()).select(*keys, "card_id").distinct().select(*keys, F.lit(1).alias("_card"))
    rows = timed.select(*keys, F.lit(1).alias("_trip"), "total_ride_sec", "total_distance", "max_transfers")
    return rows.unionByName(cards, allowMissingColumns=True).groupBy(*keys).agg(
        F.count("_trip").alias("use_count"),
        F.count("_card").alias("unique_use_count"),
        F.median("total_ride_sec").alias("time_median"),
        F.avg("total_ride_sec").alias("time_avg"),
        F.median("total_distance").alias("distance_median"),
        F.avg("total_distance").alias("distance_avg"),
        F.median("max_transfers").alias("transfer_median"),
        F.avg("max_transfers").alias("transfer_avg"),
    )


def top_destinations(od: DataFrame, p: float = 0.97) -> DataFrame:
    """Destinations whose daily total reaches the p-quantile, largest first.

    Same-named subway destinations are one. Needs ``alight_stop`` (text),
    ``alight_name``, ``alight_mode``, ``daily_count``.
    """
    lowest = canonical_ids(od.where(F.col("alight_mode") == "T"), "alight_name", "alight_stop", ["alight_mode"])
    totals = (
        od.join(lowest, ["alight_mode", "alight_name"], "left")
        .groupBy(F.coalesce("canonical_id", "alight_stop").alias("station_id"), "alight_name", "alight_mode")
        .agg(F.round(F.sum("daily_count"), 1).alias("daily_sum"))
    )
    bar = exact_quantiles(totals, ["daily_sum"], [p]).select("value").scalar()
    return totals.where(F.col("daily_sum") >= bar).orderBy(
        F.col("daily_sum").desc(), "station_id", "alight_name", "alight_mode"
    )
