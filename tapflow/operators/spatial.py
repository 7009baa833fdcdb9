"""Distance joins, nearest sites, grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.geo import grid_wkt, planar_distance, rectangle_wkt
from ..session import grown, scratch_path
from .enrich import enrich_stops

AROUND = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]


def _cells(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    return df.withColumns(
        {
            "_cx": F.floor(F.col(x) / F.lit(size)).cast("bigint"),
            "_cy": F.floor(F.col(y) / F.lit(size)).cast("bigint"),
        }
    )


def _spread(df: DataFrame) -> DataFrame:
    """One copy of each row per cell of its 3 x 3 block."""
    block = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in AROUND])
    return (
        df.withColumn("_d", F.explode(block))
        .withColumns({"_cx": F.col("_cx") + F.col("_d.dx"), "_cy": F.col("_cy") + F.col("_d.dy")})
        .drop("_d")
    )


def within_radius(
    points: DataFrame,
    centres: DataFrame,
    radius: float,
    *,
    centre_id: str = "centre_id",
    x: str = "x_5179",
    y: str = "y_5179",
) -> DataFrame:
    """Points at most ``radius`` metres from a centre, with the distance.

    An equi join on cells of side ``radius``: only the centres, the smaller
    side, are copied to the nine cells around them.
    """
    near = _spread(
        _cells(centres.select(centre_id, F.col(x).alias("_sx"), F.col(y).alias("_sy")), "_sx", "_sy", radius)
    )
    pairs = _cells(points, x, y, radius).join(grown(near), ["_cx", "_cy"])
    away = planar_distance(F.col(x), F.col(y), F.col("_sx"), F.col("_sy"))
    return pairs.withColumn("distance_m", away).where(F.col("distance_m") <= radius).drop("_cx", "_cy", "_sx", "_sy")


#: How many times wider the cells of a level are than those of the level below.
FACTOR = 4
#: Sites of a cell that points are measured against; a cell with more is taken apart further.
LEAF = 64
#: Cells of sites that are one row for the points of a cell.
LOT = 8
#: Levels below ``first_ring``: cells of 2 km end at half a metre.
BELOW = 6


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    max_dist: float | None = None,
    *,
    key: list[str],
    site_id: str = "site_id",
    x: str = "x_5179",
    y: str = "y_5179",
    first_ring: float = 2000.0,
    leaf: int = LEAF,
) -> DataFrame:
    """Each point's nearest site (equal distances: lowest id).

    Membership in a Voronoi cell is the same as having its site nearest. With ``max_dist``, points without a site that
    near get NULL, as do points without coordinates. ``key`` must identify a point.

    Occupied cells are compared before points are (``candidate_cells``), so a point meets only the sites of cells that
    can hold its nearest one, however far away it is and however dense sites are.
    """
    points = _stored(points, "points")
    here = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*key, F.col(x).alias("_x"), F.col(y).alias("_y"))
    # Of sites at one place the lowest id is the nearest.
    places = sites.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("_sx"), F.col(y).alias("_sy")).agg(F.min(site_id).alias("_site"))
    places = _stored(places, "sites")
    ends = [f(c) for c in ("_x", "_y") for f in (F.min, F.max)]
    both = here.select("_x", "_y").unionByName(places.select(F.col("_sx").alias("_x"), F.col("_sy").alias("_y")))
    low_x, high_x, low_y, high_y = both.agg(*ends).first()
    if low_x is None or places.isEmpty():
        kind = sites.schema[site_id].dataType
        return points.withColumns({"nearest_site": F.lit(None).cast(kind), "site_distance": F.lit(None).cast("double")})
    fine = first_ring / FACTOR**BELOW
    top = BELOW
    while fine * FACTOR**top <= max(high_x - low_x, high_y - low_y):
        top += 1

    def cells(df: DataFrame, cx: str, cy: str) -> DataFrame:
        return df.withColumns({n: F.floor((F.col(c) - F.lit(low)) / F.lit(fine)).cast("bigint") for n, c, low in (("_cx", cx, low_x), ("_cy", cy, low_y))})

    here, places = cells(here, "_x", "_y"), cells(places, "_sx", "_sy")
    best = None
    for level, pairs in candidate_cells(here, places, top, max_dist, leaf):
        away = lambda sx, sy: planar_distance(F.col("_x"), F.col("_y"), sx, sy)
        theirs = _at(places, level).select(F.col("_cx").alias("_qx"), F.col("_cy").alias("_qy"), "_sx", "_sy", "_site")
        nearest = F.struct(away(F.col("_sx"), F.col("_sy")).alias("_away"), "_site")
        if level:
            # A cell of a pair holds at most ``leaf`` sites here: they are one row, and a point gets a row per ``LOT`` cells, not per site:
            # what the points of a task meet is sorted there before it is put together.
            wanted = grown(pairs.select("_qx", "_qy").distinct())
            theirs = theirs.join(wanted, ["_qx", "_qy"], "left_semi").groupBy("_qx", "_qy").agg(F.collect_list(F.struct("_sx", "_sy", "_site")).alias("_sites"))
            nearest = F.array_min(F.transform("_sites", lambda s: F.struct(away(s["_sx"], s["_sy"]).alias("_away"), s["_site"].alias("_site"))))
            turn = F.row_number().over(Window.partitionBy("_px", "_py").orderBy("_qx", "_qy"))
            pairs = pairs.withColumn("_lot", F.floor((turn - 1) / LOT))
        lot = ["_lot"] if level else []
        pairs = pairs.select(F.col("_px").alias("_cx"), F.col("_py").alias("_cy"), "_qx", "_qy", *lot).join(grown(theirs), ["_qx", "_qy"])
        if level:
            pairs = pairs.groupBy("_cx", "_cy", "_lot").agg(F.flatten(F.collect_list("_sites")).alias("_sites"))
        met = _at(here, level).join(grown(pairs), ["_cx", "_cy"]).select(*key, nearest.alias("_near"))
        best = met if best is None else best.unionByName(met)
    found = best.groupBy(*key).agg(F.min("_near").alias("_near"))
    if max_dist is not None:
        found = found.where(F.col("_near._away") <= max_dist)
    found = found.select(*key, F.col("_near._site").alias("nearest_site"), F.col("_near._away").alias("site_distance"))
    return points.join(grown(found), key, "left")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _at(df: DataFrame, level: int) -> DataFrame:
    """Rows with their cell of a level; cells of level 0 are the finest."""
    return df.withColumns({c: F.floor(F.col(c) / F.lit(FACTOR**level)).cast("bigint") for c in ("_cx", "_cy")})


def _occupied(df: DataFrame, level: int, px: str, py: str) -> DataFrame:
    """The occupied cells of a level with how many rows they hold and the box around these."""
    box = [f(c).alias(n) for n, f, c in (("_x0", F.min, px), ("_x1", F.max, px), ("_y0", F.min, py), ("_y1", F.max, py))]
    return _at(df, level).groupBy("_cx", "_cy").agg(F.count(F.lit(1)).alias("_n"), *box)


def candidate_cells(points: DataFrame, sites: DataFrame, top: int, max_dist: float | None, leaf: int) -> list[tuple[int, DataFrame]]:
    """(level, pairs (_px, _py, _qx, _qy)): which occupied cells of sites may hold the nearest site of a cell's points.

    From one cell over everything downwards (first two levels at once, at most 256 cells each), each pair of cells gives the pairs of its occupied parts. The farthest that a
    point of a cell can have to a site is bounded by the box of any cell of sites; pairs whose boxes are farther apart
    than the least such bound go. At ``first_ring`` and below, a pair whose cell of sites holds at most ``leaf`` is
    done; others are taken apart further, down to cells that hold one place.
    """
    out: list[tuple[int, DataFrame]] = []
    # Upper levels are made from the occupied cells of ``first_ring``, which are few.
    base = [_stored(_occupied(df, BELOW, px, py), "occupied") for df, px, py in ((points, "_x", "_y"), (sites, "_sx", "_sy"))]

    def parts(df: DataFrame, cells: DataFrame, level: int, px: str, py: str) -> DataFrame:
        if level < BELOW:
            return _occupied(df, level, px, py)
        merged = [F.sum("_n").alias("_n"), *[f(c).alias(c) for c, f in (("_x0", F.min), ("_x1", F.max), ("_y0", F.min), ("_y1", F.max))]]
        return _at(cells, level - BELOW).groupBy("_cx", "_cy").agg(*merged)

    def named(cells: DataFrame, to: str, above: int) -> DataFrame:
        up = [F.floor(F.col(f"_c{d}") / F.lit(FACTOR**above)).cast("bigint").alias(f"_{to}p{d}") for d in "xy"]
        return cells.select(*up, *[F.col(f"_c{d}").alias(f"_{to}{d}") for d in "xy"], *[F.col(c).alias(f"_{to}{c}") for c in ("_n", "_x0", "_x1", "_y0", "_y1")])

    pairs = None
    for level in range(top - 2 if top - 2 >= BELOW else top - 1, -1, -1):
        above = 1 if pairs is not None else top - level
        mine, theirs = named(parts(points, base[0], level, "_x", "_y"), "p", above), named(parts(sites, base[1], level, "_sx", "_sy"), "q", above)
        if pairs is None:
            # The cell above is one for all.
            met = mine.withColumn("_bound", F.lit(float("inf") if max_dist is None else float(max_dist))).join(theirs, (F.col("_ppx") == F.col("_qpx")) & (F.col("_ppy") == F.col("_qpy")))
        else:
            up = pairs.select(*[F.col(f"_{t}{d}").alias(f"_{t}p{d}") for t in "pq" for d in "xy"], "_bound")
            # Below ``first_ring`` cells are bounded by the places alone.
            side = grown if level < BELOW else (lambda df: df)
            met = up.join(side(mine), ["_ppx", "_ppy"]).join(side(theirs), ["_qpx", "_qpy"])
        gap = [F.greatest(F.lit(0.0), F.col(f"_q_{d}0") - F.col(f"_p_{d}1"), F.col(f"_p_{d}0") - F.col(f"_q_{d}1")) for d in "xy"]
        span = [F.greatest(F.col(f"_q_{d}1") - F.col(f"_p_{d}0"), F.col(f"_p_{d}1") - F.col(f"_q_{d}0")) for d in "xy"]
        met = met.withColumns({"_near": F.sqrt(gap[0] * gap[0] + gap[1] * gap[1]), "_far": F.sqrt(span[0] * span[0] + span[1] * span[1])})
        least = F.least("_bound", F.min("_far").over(Window.partitionBy("_px", "_py")))
        # Wider than any rounding of metres.
        kept = met.withColumn("_bound", least).where(F.col("_near") <= F.col("_bound") * (1 + 1e-9) + 1e-6)
        pairs = kept.select("_px", "_py", "_qx", "_qy", "_bound", F.col("_q_n").alias("_n"))
        if level > BELOW:
            continue
        pairs = _stored(pairs, "cell-pairs")
        out.append((level, pairs if level == 0 else pairs.where(F.col("_n") <= leaf)))
        pairs = pairs.where(F.col("_n") > leaf)
        if pairs.isEmpty():
            break
    return out


def attach_grid(od: DataFrame, stops: DataFrame, month: str | None = None) -> DataFrame:
    """Monthly OD with stop names and grid cells at both ends (LEFT join), as they were in ``month`` if given."""
    dim = stops.withColumn("stop_id", F.col("stop_id").cast("string")).withColumnsRenamed(
        {"stop_name": "name", "grid_id": "grid"}
    )
    return enrich_stops(od, dim, ["name", "grid"], month=month)


def grid_od(od_with_grid: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Trips between cells; ends without a cell form their own group."""
    return od_with_grid.groupBy("board_grid", "alight_grid", "trip_type", *extra).agg(
        F.sum("trips").alias("trips"), F.count(F.lit(1)).alias("od_pairs")
    )


def decode_grid_od(
    df: DataFrame, drop_grid: bool = False, board: str = "board_grid", alight: str = "alight_grid"
) -> DataFrame:
    """WKT points of the cells at both ends; malformed cells give NULL."""
    out = df.withColumns({"board_wkt": grid_wkt(F.col(board)), "alight_wkt": grid_wkt(F.col(alight))})
    return out.drop(board, alight) if drop_grid else out


def obstacle_cells(df: DataFrame, regions: list[str], ym: str | None = None) -> DataFrame:
    """Grid cells marked as traffic obstacles in the given regions, as rectangles."""
    kept = df.where((F.col("obstacle_yn") == "1") & F.col("region_code").isin(*regions))
    if ym is not None:
        kept = kept.where(F.col("ym") == ym)
    return kept.withColumn(
        "cell_wkt", rectangle_wkt(F.col("lon_min"), F.col("lat_min"), F.col("lon_max"), F.col("lat_max"))
    )


def group_centroid(df: DataFrame, key: list[str], x: str, y: str, carried: list[str], order: str) -> DataFrame:
    """Mean point of each group; carried columns come from its first row."""
    return df.groupBy(*key).agg(
        F.avg(x).alias("centre_x"),
        F.avg(y).alias("centre_y"),
        F.count(F.lit(1)).alias("members"),
        *[F.min_by(c, order).alias(c) for c in carried],
    )
