"""Stops that change: monthly snapshots as versions with validity, and point-in-time joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schema import STOP_KEY
from .clean import located_stops
from .ordering import dedup

#: ``valid_to`` of a version that the last snapshot still has.
OPEN_END = "999999"


def versions(snapshots: DataFrame, key: list[str], month: str = "ym") -> DataFrame:
    """Slowly changing dimension: one row per key and state, with ``valid_from`` (first month) and ``valid_to`` (first month after).

    ``snapshots`` has one row per ``month`` (yyyyMM text) and key. A snapshot holds until the next one, so months without
    a snapshot take the last one before them. A key that a snapshot lacks ends there; if it comes back, that is a new
    version even with the old state.
    """
    state = [c for c in snapshots.columns if c not in (month, *key)]
    # One row per snapshot.
    every = snapshots.select(month).distinct()
    until = every.select(month, F.coalesce(F.lead(month).over(Window.orderBy(month)), F.lit(OPEN_END)).alias("_until"))
    dated = snapshots.join(F.broadcast(until), month)
    w = Window.partitionBy(*key).orderBy(month)
    now = F.struct(*state) if state else F.struct(F.lit(1))
    same = F.lag(now).over(w).eqNullSafe(now) & F.lag("_until").over(w).eqNullSafe(F.col(month))
    numbered = dated.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_version", F.sum("_new").over(w))
    return (
        numbered.groupBy(*key, "_version")
        .agg(*[F.first(c).alias(c) for c in state], F.min(month).alias("valid_from"), F.max("_until").alias("valid_to"))
        .drop("_version")
    )


def stop_history(raw: DataFrame, month: str = "ym", mode: str = "paired") -> DataFrame:
    """Clean stop dimension of many snapshots: as ``build_stops``, one row per key and version.

    Versions are made of the raw attributes, so coordinates are repaired and projected once per version and not once
    per snapshot. A version without usable coordinates drops out: its months have no such stop.
    """
    one = dedup(raw, [month, *STOP_KEY], ["stop_name", "gps_x", "gps_y"])
    return located_stops(versions(one, STOP_KEY, month), mode)


def valid_in(month: Column, start: Column | str = "valid_from", end: Column | str = "valid_to") -> Column:
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return (month >= as_col(start)) & (month < as_col(end))


def of_months(history: DataFrame, months: list[str], month: str = "ym") -> DataFrame:
    """The dimension as it stands in each of the given months, one row per key and month."""
    held = F.filter(F.array(*[F.lit(m) for m in months]), lambda m: valid_in(m))
    return history.withColumn(month, F.explode(held)).drop("valid_from", "valid_to")
