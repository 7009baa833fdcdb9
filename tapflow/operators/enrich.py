"""Joins of trips with the stop dimension and integrity audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import grown, scratch_path
from ..functions.numbers import half_even
from ..schema import STOP_KEY


def _stop_side(stops: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    return stops.select(
        F.col("stop_id").alias(f"{prefix}_stop"),
        F.col("region_code").alias(f"{prefix}_region"),
        F.col("mode").alias(f"{prefix}_mode"),
        *[F.col(c).alias(f"{prefix}_{c}") for c in cols],
    )


def enrich_stops(
    trips: DataFrame, stops: DataFrame, cols: list[str], sides: tuple[str, ...] = ("board", "alight"), month: str | None = None
) -> DataFrame:
    """LEFT join of stop attributes at both ends on the three-column key.

    ``stops`` must be unique on its key, so the row count is kept. With ``month``, a column of ``trips``, ``stops`` is a
    history (``valid_from``, ``valid_to``): an equi join on the key takes the version that holds in the row's month.
    Versions of a key don't overlap, so the row count is kept there too.
    """
    if month is not None:
        for side in sides:
            dim = stops.select(
                *[F.col(c).alias(f"_{c}") for c in (*STOP_KEY, "valid_from", "valid_to")], *[F.col(c).alias(f"{side}_{c}") for c in cols]
            )
            ends = zip(("stop", "region", "mode"), STOP_KEY)
            same = [F.col(f"{side}_{end}") == F.col(f"_{key}") for end, key in ends]
            holds = (F.col(month) >= F.col("_valid_from")) & (F.col(month) < F.col("_valid_to"))
            trips = trips.join(grown(dim), [*same, holds], "left").drop(*[f"_{c}" for c in (*STOP_KEY, "valid_from", "valid_to")])
        return trips
    dim = stops.select(*STOP_KEY, *cols)
    for side in sides:
        trips = trips.join(
            grown(_stop_side(dim, cols, side)), [f"{side}_stop", f"{side}_region", f"{side}_mode"], "left"
        )
    return trips


def canonicalise_stops(df: DataFrame, transfer_map: DataFrame, month: tuple[str, ...] = ()) -> DataFrame:
    """Replace transfer-station ids at both ends; ids become text.

    ``month`` names a column of both sides where the map differs from month to month.
    """
    known = transfer_map.where(F.col("canonical_stop_id").isNotNull())
    for side in ("board", "alight"):
        mapping = known.select(
            F.col("stop_id").cast("string").alias(f"{side}_stop"),
            F.col("region_code").alias(f"{side}_region"),
            F.col("mode").alias(f"{side}_mode"),
            F.col("canonical_stop_id").alias("_to"),
            *month,
        )
        df = (
            df.withColumn(f"{side}_stop", F.col(f"{side}_stop").cast("string"))
            .join(grown(mapping), [f"{side}_stop", f"{side}_region", f"{side}_mode", *month], "left")
            .withColumn(f"{side}_stop", F.coalesce("_to", f"{side}_stop"))
            .drop("_to")
        )
    return df


def _matched(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> DataFrame:
    """``left`` with ``_hit``: TRUE where the key exists in ``right``.
    The right side is reduced to distinct keys, so rows never multiply."""
    known = right.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(keys.values())]).distinct()
    cond = None
    for i, l in enumerate(keys):
        test = F.col(l) == F.col(f"_k{i}")
        cond = test if cond is None else cond & test
    joined = left.join(grown(known.withColumn("_hit", F.lit(True))), cond, "left")
    return joined.select(*left.columns, F.coalesce("_hit", F.lit(False)).alias("_hit"))


def _audit_columns(id_col: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("_hit"), 1)).alias("matched"),
        F.count(F.when(~F.col("_hit"), 1)).alias("unmatched"),
        F.countDistinct(id_col).alias("ids"),
        F.countDistinct(F.when(~F.col("_hit"), F.col(id_col))).alias("unmatched_ids"),
    ]


def _with_rates(audit: DataFrame) -> DataFrame:
    def pct(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, half_even(F.col(part) / F.col(whole) * 100.0, 2))

    return audit.withColumns(
        {
            "matched_pct": pct("matched", "rows"),
            "unmatched_pct": pct("unmatched", "rows"),
            "unmatched_ids_pct": pct("unmatched_ids", "ids"),
        }
    )


def join_audit(left: DataFrame, right: DataFrame, keys: dict[str, str], id_col: str) -> DataFrame:
    """Match counts and rates of a lookup, over rows and over distinct ids."""
    return _with_rates(_matched(left, right, keys).agg(*_audit_columns(id_col)))


def join_audit_by(left: DataFrame, right: DataFrame, keys: dict[str, str], id_col: str, group: str) -> DataFrame:
    """The same per group, plus a ``total`` row.

    Rows are first counted by (group, id, hit); that table, read twice, gives rows and distinct ids of both.
    """
    counted = _matched(left, right, keys).groupBy(F.col(group).alias("grp"), F.col(id_col).alias("id"), "_hit").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(left.sparkSession, "join-audit")
    counted.write.parquet(path)
    counted = left.sparkSession.read.parquet(path)

    def summed(ids: DataFrame, keys: list[str]) -> DataFrame:
        """``ids``: one row per id with its matched and unmatched rows."""
        known = F.col("id").isNotNull()
        return ids.groupBy(*keys).agg(
            F.coalesce(F.sum(F.col("hits") + F.col("misses")), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("hits"), F.lit(0)).alias("matched"),
            F.coalesce(F.sum("misses"), F.lit(0)).alias("unmatched"),
            F.count(F.when(known, 1)).alias("ids"),
            F.count(F.when(known & (F.col("misses") > 0), 1)).alias("unmatched_ids"),
        )

    sides = [F.sum(F.when(F.col("_hit") == hit, F.col("n")).otherwise(0)).alias(name) for hit, name in ((True, "hits"), (False, "misses"))]
    per = summed(counted.groupBy("grp", "id").agg(*sides), ["grp"])
    total = summed(counted.groupBy("id").agg(*sides), []).select(F.lit("total").alias("grp"), "*")
    return _with_rates(per.unionByName(total))


def unmatched_rows(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> DataFrame:
    return _matched(left, right, keys).where(~F.col("_hit")).drop("_hit")


def relabel_grid(df: DataFrame, letters: DataFrame, cols: list[str]) -> DataFrame:
    """Swap the first two letters of each cell by a lookup table
    (``alphabet``, ``local``); unknown and NULL cells stay as they are."""
    for c in cols:
        lookup = letters.select(F.col("alphabet").alias("_from"), F.col("local").alias("_to"))
        df = (
            df.join(lookup, F.substring(F.col(c), 1, 2) == F.col("_from"), "left")
            .withColumn(c, F.coalesce(F.concat(F.col("_to"), F.substring(F.col(c), F.lit(3), F.length(c))), F.col(c)))
            .drop("_from", "_to")
        )
    return df


def commuter_trips(trips: DataFrame, anchor_cells: DataFrame) -> DataFrame:
    """Trips of cards with a known home and work cell, with those cells."""
    return trips.join(grown(anchor_cells.select("card_id", "home_cell", "work_cell")), "card_id")


def canonical_ids(df: DataFrame, name: str, id_col: str, by: list[str]) -> DataFrame:
    """Lowest id per name (within ``by``) where a name has several ids."""
    return (
        df.where(F.col(name).isNotNull())
        .groupBy(*by, name)
        .agg(F.min(id_col).alias("canonical_id"), F.countDistinct(id_col).alias("n_ids"))
        .where(F.col("n_ids") > 1)
        .drop("n_ids")
    )


def transfer_map_from_names(stops: DataFrame, mode: str = "T", month: tuple[str, ...] = ()) -> DataFrame:
    """Transfer mapping of same-named subway stops within a region (and, if named, a month)."""
    subway = stops.where(F.col("mode") == mode)
    by = ["region_code", "mode", *month]
    lowest = canonical_ids(subway, "stop_name", "stop_id", by)
    return subway.join(grown(lowest), [*by, "stop_name"]).select(
        *month,
        F.col("stop_id").cast("string").alias("stop_id"),
        "region_code",
        "mode",
        F.col("canonical_id").cast("string").alias("canonical_stop_id"),
    )
