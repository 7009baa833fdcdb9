"""End-to-end jobs, composed of the operators.

A frame that several branches read (trips, the stop dimension, anchors) is
written once to the shared folder as Parquet: later branches read only the
columns they need, and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.times import year_month
from ..schema import DAILY_LOAD, OD_LOAD, Contract
from ..session import scratch_path
from ..sources import published
from ..sources.writers import overwrite_partitions, write_table
from ..operators import anchors as anchor_ops
from ..operators import catchment, clean, dwell, enrich, history, od, quality, spatial
from ..operators.calendar import business_day_counts
from ..operators.ordering import dedup
from ..operators.trips import purpose_trips, purpose_trips_by_leg
from ..schema import STOP_KEY


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to and read back from the shared folder."""
    path = scratch_path(df.sparkSession, label)
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def find_anchors(
    trips: DataFrame, stops: DataFrame, holidays: DataFrame, by_month: bool = False, small_card: int = anchor_ops.SMALL_CARD
) -> DataFrame:
    """Home and work stops of every card with enough rows in both windows.

    ``by_month``: cards are those of ``cards_of_months`` and ``stops`` a history. Cards with more than ``small_card``
    visited stops are clustered by joins.
    """
    visits = anchor_ops.eligible_visits(anchor_ops.trip_visits(trips, holidays))
    keyed = visits.withColumnsRenamed({"stop_id": "at_stop", "region_code": "at_region", "mode": "at_mode"})
    if by_month:
        keyed = keyed.withColumn("ym", F.substring_index("card_id", MONTH_OF_CARD, 1))
    located = enrich.enrich_stops(keyed, stops, ["stop_name", "x_5179", "y_5179"], ("at",), "ym" if by_month else None).withColumnsRenamed(
        {
            "at_stop": "stop_id",
            "at_region": "region_code",
            "at_mode": "mode",
            "at_stop_name": "stop_name",
            "at_x_5179": "x",
            "at_y_5179": "y",
        }
    )
    return anchor_ops.anchors_from_visits(located.drop("ym"), small_card=small_card)


MONTH_OF_CARD = "|"


def cards_of_months(trips: DataFrame) -> DataFrame:
    """A card is another card in each month (``ym``): home and work are those of the month."""
    return trips.withColumn("card_id", F.concat("ym", F.lit(MONTH_OF_CARD), "card_id"))


def commute_od_of_months(taps: DataFrame, snapshots: DataFrame, holidays: DataFrame) -> DataFrame:
    """``monthly_commute_od`` of many months in one run, each by itself and by the stops of its time.

    ``snapshots`` are raw stops with the month (``ym``, yyyyMM) of each extract. Home and work stops, names, cells and
    merged transfer stations of a month come from the versions that hold in it: its own snapshot or the last one before.
    """
    trips = staged(cards_of_months(purpose_trips(taps).withColumn("ym", year_month(F.col("op_date")))), "trips")
    stops = staged(history.stop_history(snapshots), "stop-history")
    found = staged(find_anchors(trips, stops, holidays, by_month=True), "anchors")
    # As many values as months are loaded at once.
    months = sorted(row["ym"] for row in trips.select("ym").distinct().collect())
    mapping = enrich.transfer_map_from_names(history.of_months(stops, months), month=("ym",))
    return spatial.attach_grid(od.commute_od(trips, found, mapping, holidays, extra_keys=("ym",)), stops, "ym")


def monthly_commute_od(
    taps: DataFrame, raw_stops: DataFrame, holidays: DataFrame, transfer_map: DataFrame | None = None
) -> DataFrame:
    """Taps to monthly commuting OD with stop names and grid cells."""
    trips = staged(purpose_trips(taps).withColumn("ym", year_month(F.col("op_date"))), "trips")
    stops = staged(clean.build_stops(raw_stops), "stops")
    found = staged(find_anchors(trips, stops, holidays), "anchors")
    mapping = transfer_map if transfer_map is not None else enrich.transfer_map_from_names(stops)
    monthly = od.commute_od(trips, found, mapping, holidays, extra_keys=("ym",))
    return spatial.attach_grid(monthly, stops)


def station_cells(stops: DataFrame, max_dist: float | None = None) -> DataFrame:
    """Stops with the nearest subway station as ``cell_id``; same-named
    stations of a region are one site at their centroid."""
    subway = stops.where((F.col("mode") == "T") & F.col("x_5179").isNotNull())
    sites = spatial.group_centroid(
        subway, ["region_code", "stop_name"], "x_5179", "y_5179", ["stop_id"], "stop_id"
    ).select(F.col("stop_id").alias("site_id"), F.col("centre_x").alias("x_5179"), F.col("centre_y").alias("y_5179"))
    return spatial.nearest_site(stops, sites, max_dist, key=STOP_KEY).withColumnRenamed("nearest_site", "cell_id")


def cell_commute_od_job(taps: DataFrame, raw_stops: DataFrame, max_dist: float | None = None) -> DataFrame:
    """Older rule: leg self-join trips, station cells, modal agreement, OD in
    both directions (``direction`` tells which)."""
    trips = staged(clean.drop_inverted(purpose_trips_by_leg(taps)), "leg-trips")
    stops = staged(station_cells(staged(clean.build_stops(raw_stops), "stops"), max_dist), "cells")
    cells = staged(anchor_ops.anchor_cells(trips, stops), "anchor-cells")
    return od.cell_commutes(trips, cells, stops)


def dwell_job(taps: DataFrame, stops: DataFrame, parts: int | None = None) -> DataFrame:
    """Dwell statistics per day, stop and activity. ``stops`` carries ``cell_id``."""
    trips = staged(clean.drop_inverted(purpose_trips_by_leg(taps)), "leg-trips")
    dim = staged(dedup(stops, STOP_KEY, ["stop_name", "gps_x", "gps_y"]), "stops")
    cells = staged(anchor_ops.anchor_cells(trips, dim), "anchor-cells")
    return dwell.dwell_stats(dwell.dwell_events(trips, cells, dim, parts), dim)


def publish_od(
    od_with_grid: DataFrame, holidays: DataFrame, path: str | None = None, months: list[str] | None = None, at_once: bool = False
) -> DataFrame:
    """The published table of all months in ``od_with_grid``: daily means over
    business days, WKT points, local cells. Rows that break the load contract
    stop the job. With ``path`` the months (``months``, if named) are replaced there: partition by partition in a plain
    Parquet folder or, ``at_once``, by one commit (``sources.published``)."""
    days = business_day_counts(od_with_grid.select("ym"), holidays)
    rows = clean.to_published_od(od_with_grid, days)
    return rows if path is None else loaded(rows, OD_LOAD, path, ["standard_ym"], months, at_once)


def publish_daily_od(matched: DataFrame, stops: DataFrame, path: str | None = None, months: list[str] | None = None) -> DataFrame:
    """The published daily table of commuting trips (``match_commutes``): the hourly cube with names, cells and points.

    With ``path``, partitions are first the month and then the day; they are replaced by one commit.
    """
    cube = od.od_hourly(matched, ("trip_type",))
    dim = stops.withColumnsRenamed({"stop_name": "name", "grid_id": "grid"})
    rows = clean.to_published_daily(enrich.enrich_stops(cube, dim, ["name", "grid"]))
    if path is None:
        return rows
    dated = rows.withColumn("standard_ym", year_month(F.col("standard_date")))
    return loaded(dated, DAILY_LOAD, path, ["standard_ym", "standard_date"], months).select(*rows.columns)


def loaded(
    rows: DataFrame, contract: Contract, path: str, by: list[str], named: list[str] | None = None, at_once: bool = True
) -> DataFrame:
    """``rows`` held to their contract and loaded at ``path``; returns the whole table as it stands then."""
    rows = staged(rows, "published")
    broken = quality.validate_target(rows, contract).where(F.col("violations") > 0)
    # At most one row per rule of the contract.
    found = broken.collect()
    if found:
        raise ValueError(f"load contract broken: {[row.asDict() for row in found]}")
    typed = quality.to_target_types(rows, contract)
    if at_once:
        published.load(typed, path, by, named)
        return published.read(rows.sparkSession, path)
    overwrite_partitions(typed, path, by, named)
    return df_from(path, rows)


def df_from(path: str, like: DataFrame) -> DataFrame:
    """The written table in the column order of ``like``."""
    back = like.sparkSession.read.parquet(path)
    return back.withColumn("standard_ym", F.col("standard_ym").cast("string")).select(*like.columns)


def catchment_report(
    trips: DataFrame, stops: DataFrame, centres: DataFrame, radius: float = 700.0, key: list[str] = ("card_id",)
) -> dict[str, DataFrame]:
    """Study of the trips around given centres: funnel, means, half-hour
    curves, return distances, arrival by departure hours, commuters."""
    key = list(key)
    near = staged(spatial.within_radius(stops, centres, radius), "near")
    located = enrich.enrich_stops(trips, stops, ["x_5179", "y_5179"])
    around = staged(clean.touching(located, near, "either"), "around")
    two = staged(catchment.two_trip_days(around, near, key), "two")
    commuters = two.where(F.col("returning") & F.col("commuting"))
    gaps = catchment.return_gap(around, key)
    return {
        "funnel": quality.funnel(
            {
                "touching": around,
                "boarding": clean.touching(around, near, "board"),
                "alighting": clean.touching(around, near, "alight"),
                "internal": clean.touching(around, near, "both"),
                "two_trips": two,
                "returning": two.where("returning"),
                "commuting": commuters,
            },
            "card_id",
        ),
        "trips_per_card": quality.freq_of_freq(around, key),
        "means": catchment.mean_ride(around, near),
        "board_curve": quality.resample_counts(clean.touching(around, near, "board"), "board_ts"),
        "alight_curve": quality.resample_counts(clean.touching(around, near, "alight"), "alight_ts"),
        "return_bins": quality.bin_counts(gaps, "distance"),
        "hours": quality.hour_crosstab(two, key),
        "commuters": commuters.drop("returning", "commuting"),
    }


def quality_report(
    taps: DataFrame, stops: DataFrame, route_stops: DataFrame, raw: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Profiles and integrity checks of a tap extract and its dimensions.

    ``raw``: (ts_text, date_text) of the extract before its times are parsed; without it the boarding times are
    checked as they were parsed, which shows other days only.
    """
    if raw is None:
        raw = taps.select(
            F.date_format("board_ts", "yyyyMMddHHmmss").alias("ts_text"), F.date_format("op_date", "yyyyMMdd").alias("date_text")
        )
    faults = [F.count_if(c).alias(c) for c in ("bad_digit", "unparsable", "other_day")]
    key = {"board_stop": "stop_id", "region_code": "region_code", "mode": "mode"}
    moded = clean.with_mode(taps, "mode_code")
    return {
        "nulls": quality.null_profile(taps),
        "columns": quality.column_profile(taps),
        "key_copies": quality.duplicate_keys(stops, STOP_KEY),
        "card_lengths": quality.length_profile(taps, "card_id"),
        "coordinates": clean.coord_issues(stops, "gps_x", "gps_y"),
        "inverted": clean.inverted(taps).agg(F.count(F.lit(1)).alias("rows")),
        "bad_timestamps": clean.bad_timestamps(raw, "ts_text", "date_text").agg(F.count(F.lit(1)).alias("rows"), *faults),
        "board_stops": enrich.join_audit(moded, stops, key, "board_stop"),
        "board_stops_by_region": enrich.join_audit_by(moded, stops, key, "board_stop", "region_code"),
        "stop_ids": quality.key_diff(route_stops, stops, "stop_id", "stop_id"),
    }
