"""Projections, filters and repairs (one row in, at most one row out)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import ADULT, mode_of, purpose_name
from ..functions.geo import grid_cell, grid_wkt, local_grid, project
from ..functions.numbers import half_even, text_to_id
from ..functions.times import hour_in, tap_date, tap_time
from ..schema import PUBLISHED_DAILY_COLUMNS, PUBLISHED_OD_COLUMNS, STOP_KEY
from ..session import grown
from .ordering import dedup

# Sentinel limit and bounding box of valid coordinates.
SENTINEL = 1000.0
LON_RANGE = (124.0, 132.0)
LAT_RANGE = (33.0, 38.9)
# A value above this is a longitude, below it a latitude.
SWAP_SPLIT = 100.0


def with_mode(df: DataFrame, code_col: str, extra_codes: tuple[int, ...] = (), name: str = "mode") -> DataFrame:
    return df.withColumn(name, mode_of(F.col(code_col), extra_codes))


def adults(df: DataFrame, col: str = "user_type") -> DataFrame:
    return df.where(F.col(col) == ADULT)


def in_hours(df: DataFrame, ts_col: str, lo: int, hi: int) -> DataFrame:
    return df.where(hour_in(F.col(ts_col), lo, hi))


def repair_xy(df: DataFrame, x: str, y: str, mode: str = "paired") -> DataFrame:
    """Put swapped longitude/latitude back.

    ``paired`` swaps only when both values sit in the other's range and flags
    a row where just one does (``xy_suspect``). ``independent`` tests each
    coordinate alone, so a one-sided fault doubles the good value.
    """
    lon, lat = F.col(x), F.col(y)
    y_high, x_low = lat > SWAP_SPLIT, lon < SWAP_SPLIT
    if mode == "paired":
        both = y_high & x_low
        new_y, new_x = F.when(both, lon).otherwise(lat), F.when(both, lat).otherwise(lon)
        y_flag = x_flag = both
        # Sentinels are above every range and are dropped as invalid, not flagged.
        suspect = (y_high != x_low) & (lon < SENTINEL) & (lat < SENTINEL)
    elif mode == "independent":
        new_y, new_x = F.when(y_high, lon).otherwise(lat), F.when(x_low, lat).otherwise(lon)
        y_flag, x_flag, suspect = y_high, x_low, F.lit(False)
    else:
        raise ValueError(f"unknown repair mode: {mode}")
    flag = lambda test: F.coalesce(test, F.lit(False)).cast("int")
    return df.withColumns(
        {x: new_x, y: new_y, "x_fixed": flag(x_flag), "y_fixed": flag(y_flag), "xy_suspect": flag(suspect)}
    )


def repair_stats(repaired: DataFrame) -> DataFrame:
    return repaired.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("y_fixed"), F.lit(0)).alias("y_sum"),
        F.coalesce(F.sum("x_fixed"), F.lit(0)).alias("x_sum"),
        F.coalesce(F.sum("xy_suspect"), F.lit(0)).alias("suspect_sum"),
    )


def has_coordinates(x: Column, y: Column) -> Column:
    return x.isNotNull() & y.isNotNull() & (x < SENTINEL) & (y < SENTINEL)


def coord_issues(df: DataFrame, x: str, y: str) -> DataFrame:
    """Counts and percentages of each kind of unusable coordinate."""
    lon, lat = F.col(x), F.col(y)
    tests = {
        "missing": lon.isNull() | lat.isNull(),
        "sentinel": (lon >= SENTINEL) | (lat >= SENTINEL),
        "zero": (lon == 0) | (lat == 0),
        "outside": (lon < LON_RANGE[0]) | (lon > LON_RANGE[1]) | (lat < LAT_RANGE[0]) | (lat > LAT_RANGE[1]),
    }
    one = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(test, 1)).alias(name) for name, test in tests.items()],
    )
    entries = [F.struct(F.lit(k).alias("issue"), F.col(k).alias("n"), F.col("total")) for k in tests]
    return (
        one.select(F.inline(F.array(*entries)))
        .withColumn("pct", F.when(F.col("total") > 0, half_even(F.col("n") / F.col("total") * 100.0, 2)))
    )


def strip_zeros(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.regexp_replace(F.col(c), "^0+", "") for c in cols})


def drop_inverted(df: DataFrame, start: str = "board_ts", end: str = "alight_ts") -> DataFrame:
    """Drop only rows whose start is known to lie after their end."""
    return df.where(~F.coalesce(F.col(start) > F.col(end), F.lit(False)))


def inverted(df: DataFrame, start: str = "board_ts", end: str = "alight_ts") -> DataFrame:
    """Rows that run backwards between two different stops."""
    return df.where((F.col(end) < F.col(start)) & (F.col("board_stop") != F.col("alight_stop")))


def bad_timestamps(df: DataFrame, ts_text: str, date_text: str) -> DataFrame:
    """Rows whose time text is impossible or disagrees with the service date.

    A trip may run past midnight, so the following day also agrees.
    """
    # A generated row: a filter on plain columns would be pushed below them, and make both texts anew for every use.
    texts = df.select("*", F.inline(F.array(F.struct(F.col(ts_text).alias("_ts"), F.col(date_text).alias("_day")))))
    ts, day = F.col("_ts"), F.col("_day")
    digit = lambda position: F.substring(ts, position, 1).try_cast("int")
    parsed = tap_time(ts)
    day_gap = F.date_diff(F.to_date(parsed), tap_date(day))
    checked = texts.withColumns(
        {
            "bad_digit": F.coalesce((digit(11) > 5) | (digit(13) > 5), F.lit(False)),
            "unparsable": parsed.isNull(),
            "other_day": F.coalesce(~day_gap.isin(0, 1), F.lit(False)),
        }
    )
    return checked.where(ts.isNotNull() & (F.col("bad_digit") | F.col("unparsable") | F.col("other_day"))).drop("_ts", "_day")


def cast_ids(df: DataFrame, to_long: list[str] = (), to_text: list[str] = ()) -> DataFrame:
    changes = {c: text_to_id(F.col(c)) for c in to_long}
    changes.update({c: F.col(c).cast("bigint").cast("string") for c in to_text})
    return df.withColumns(changes)


def drop_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(cols) if cols else None)


def publish_measures(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """``spec`` maps a column to ``seconds`` (minutes to whole seconds,
    truncated), ``whole`` (truncated) or ``round`` (half-even)."""
    rules = {
        "seconds": lambda c: (c * F.lit(60)).cast("bigint"),
        "whole": lambda c: c.cast("bigint"),
        "round": lambda c: F.rint(c).cast("bigint"),
    }
    return df.withColumns({name: rules[rule](F.col(name)) for name, rule in spec.items()})


def keep_cards(df: DataFrame, cards: DataFrame, key: str = "card_id") -> DataFrame:
    return df.join(grown(cards.select(key)), key, "left_semi")


def touching(df: DataFrame, stops: DataFrame, how: str = "either") -> DataFrame:
    """Trips with an end in a stop set: ``board``, ``alight``, ``both`` or ``either``."""
    listed = stops.select("stop_id").distinct()
    board = grown(listed.select(F.col("stop_id").alias("board_stop"), F.lit(True).alias("_at_board")))
    alight = grown(listed.select(F.col("stop_id").alias("alight_stop"), F.lit(True).alias("_at_alight")))
    if how == "board":
        return df.join(board, "board_stop", "left_semi")
    if how == "alight":
        return df.join(alight, "alight_stop", "left_semi")
    if how == "both":
        return df.join(board, "board_stop", "left_semi").join(alight, "alight_stop", "left_semi")
    if how != "either":
        raise ValueError(f"unknown end: {how}")
    flagged = df.join(board, "board_stop", "left").join(alight, "alight_stop", "left")
    return flagged.where(F.col("_at_board") | F.col("_at_alight")).select(*df.columns)


def negative_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column with the count of values below zero."""
    one = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(F.col(c) < 0, 1)).alias(c) for c in cols],
    )
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("negatives"), F.col("total")) for c in cols]
    return one.select(F.inline(F.array(*entries)))


def negative_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    test = F.col(cols[0]) < 0
    for c in cols[1:]:
        test = test | (F.col(c) < 0)
    return df.where(test)


def select_buildings(df: DataFrame, text_col: str, pattern: str, kind_col: str, kinds: list[str]) -> DataFrame:
    return df.where(F.col(text_col).contains(pattern) & F.col(kind_col).isin(*kinds))


def build_stops(raw: DataFrame, mode: str = "paired") -> DataFrame:
    """Clean stop dimension: one row per key, repaired and projected
    coordinates, grid cell. Missing and sentinel coordinates drop out; a
    one-sided fault stays, flagged, without metres or cell."""
    return located_stops(dedup(raw, STOP_KEY, ["stop_name", "gps_x", "gps_y"]), mode)


def located_stops(one: DataFrame, mode: str = "paired") -> DataFrame:
    """Stops, one row each, with repaired and projected coordinates and grid cell."""
    fixed = repair_xy(one, "gps_x", "gps_y", mode).where(has_coordinates(F.col("gps_x"), F.col("gps_y")))
    metres = project(fixed, "gps_x", "gps_y")
    good = F.col("xy_suspect") == 0
    return metres.withColumns(
        {"x_5179": F.when(good, F.col("x_5179")), "y_5179": F.when(good, F.col("y_5179"))}
    ).withColumn("grid_id", grid_cell(F.col("x_5179"), F.col("y_5179")))


def to_published_od(df: DataFrame, business_days: DataFrame, ym: str = "ym") -> DataFrame:
    """The published OD schema from monthly OD rows with names and cells.

    ``business_days`` has one row per month (``ym``, ``business_days``).
    """
    days = business_days.select(F.col("ym").alias(ym), "business_days")
    daily = F.when(
        F.col("business_days") > 0, half_even(F.col("trips") / F.col("business_days"), 1)
    )
    named = df.join(days, ym, "left").select(
        F.col(ym).alias("standard_ym"),
        *published_ends(),
        purpose_name(F.col("trip_type")).alias("purpose_name"),
        daily.alias("daily_use_count"),
        F.col("time_median").alias("median_elapse_time"),
        F.col("time_avg").alias("average_elapse_time"),
        F.col("distance_median").alias("median_distance"),
        F.col("distance_avg").alias("average_distance"),
    )
    return named.select(*PUBLISHED_OD_COLUMNS)


def published_ends() -> list[Column]:
    """Id, name, region, type, local cell and WKT point of both ends under their published names."""
    out = []
    for end, name in (("board", "departure"), ("alight", "arrival")):
        out += [
            F.col(f"{end}_stop").cast("string").alias(f"{name}_station_id"),
            F.col(f"{end}_name").alias(f"{name}_station_name"),
            F.col(f"{end}_region").alias(f"{name}_region_code"),
            F.col(f"{end}_mode").alias(f"{name}_station_type"),
            local_grid(F.col(f"{end}_grid")).alias(f"{name}_grid_id"),
            grid_wkt(F.col(f"{end}_grid")).alias(f"{name}_station_geometry"),
        ]
    return out


def to_published_daily(cube: DataFrame) -> DataFrame:
    """The published daily schema from rows of the hourly OD cube (with ``trip_type``) with names and cells."""
    named = cube.select(
        F.col("op_date").alias("standard_date"),
        F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour"),
        *published_ends(),
        purpose_name(F.col("trip_type")).alias("trip_type"),
        "use_count",
        "unique_use_count",
        F.col("time_median").alias("median_elapse_time"),
        F.col("time_avg").alias("average_elapse_time"),
        F.col("distance_median").alias("median_distance"),
        F.col("distance_avg").alias("average_distance"),
        F.col("transfer_median").alias("median_transfer_count"),
        F.col("transfer_avg").alias("average_transfer_count"),
    )
    return named.select(*PUBLISHED_DAILY_COLUMNS)
