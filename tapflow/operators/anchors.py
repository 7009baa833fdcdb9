"""Home and work stops of a card: candidate windows, modal cells, density clusters."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import planar_distance
from ..functions.numbers import half_even
from ..functions.times import hour_in
from ..session import cut
from .calendar import business_days_only
from .enrich import enrich_stops

# Default hour windows and clustering parameters.
AM_HOURS = (6, 10)
PM_HOURS = (16, 24)
CELL_AM_HOURS = (6, 12)
EPS_METRES = 800.0
MIN_ROWS = 10
MIN_CONFIDENCE = 0.5

# Which end of a trip points at home or work in which half of the day.
CANDIDATE_ENDS = {
    "residence": (("board", AM_HOURS), ("alight", PM_HOURS)),
    "office": (("board", PM_HOURS), ("alight", AM_HOURS)),
}

# Cards with at most this many visited stops are clustered in one row; larger
# ones by joins over distance blocks. Both give the same clusters.
SMALL_CARD = 128


def window_rows(trips: DataFrame, holidays: DataFrame, kinds: tuple[str, ...] = tuple(CANDIDATE_ENDS)) -> DataFrame:
    """One row per trip end on business days in the hours that hint at a kind of place, from one read of the trips."""
    days = business_days_only(trips, "op_date", holidays)
    ends = [
        F.when(
            hour_in(F.col(f"{end}_ts"), *hours),
            F.struct(
                F.lit(kind).alias("location_type"),
                F.col(f"{end}_stop").alias("stop_id"),
                F.hour(f"{end}_ts").alias("hour"),
                F.lit(end).alias("type"),
                F.col(f"{end}_region").alias("region_code"),
                F.col(f"{end}_mode").alias("mode"),
                F.col(f"{end}_ts").alias("event_ts"),
            ),
        )
        for kind in kinds
        for end, hours in CANDIDATE_ENDS[kind]
    ]
    return days.select("op_date", "card_id", F.inline(F.array_compact(F.array(*ends))))


def candidates(
    trips: DataFrame,
    stops: DataFrame,
    holidays: DataFrame,
    cols: tuple[str, ...] = ("stop_name", "gps_y", "gps_x"),
    kinds: tuple[str, ...] = tuple(CANDIDATE_ENDS),
) -> DataFrame:
    """Stops a card used in the hours that hint at its home and work (``location_type``), long form.

    All ends of all windows meet the stops in one join.
    """
    at = {"stop_id": "at_stop", "region_code": "at_region", "mode": "at_mode"}
    named = enrich_stops(window_rows(trips, holidays, kinds).withColumnsRenamed(at), stops, list(cols), ("at",))
    back = {new: old for old, new in at.items()} | {f"at_{c}": c for c in cols}
    key = ["op_date", "card_id", "stop_id", "hour", "type", "region_code", "mode"]
    return named.withColumnsRenamed(back).select(*key, *cols, "event_ts", "location_type")


def candidate_stops(
    trips: DataFrame, stops: DataFrame, holidays: DataFrame, kind: str, cols: tuple[str, ...] = ("stop_name", "gps_y", "gps_x")
) -> DataFrame:
    """``candidates`` for ``residence`` or ``office`` alone."""
    return candidates(trips, stops, holidays, cols, (kind,)).drop("location_type")


def enough_rows(rows: DataFrame, n: int = MIN_ROWS) -> DataFrame:
    """Cards with at least ``n`` rows in each window, of rows of both (``window_rows``, ``candidates``): one count a card."""
    each = [F.count_if(F.col("location_type") == kind) >= n for kind in CANDIDATE_ENDS]
    return rows.groupBy("card_id").agg((each[0] & each[1]).alias("_enough")).where("_enough").select("card_id")


def valid_cards(home: DataFrame, work: DataFrame, n: int = MIN_ROWS) -> DataFrame:
    """Cards with at least ``n`` rows in both windows."""

    def enough(df: DataFrame) -> DataFrame:
        return df.groupBy("card_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select("card_id")

    return enough(home).intersect(enough(work))


# --- visits: candidate rows collapsed to distinct stops ---------------------------------


def trip_visits(trips: DataFrame, holidays: DataFrame) -> DataFrame:
    """Both candidate windows, collapsed before any stop is looked up.

    One row per (window, card, stop) with its row count and first use: what
    clustering needs, in one pass over the trips and one shuffle.
    """
    rows = window_rows(trips, holidays)
    return rows.groupBy("location_type", "card_id", "stop_id", "region_code", "mode").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_ts").alias("first_ts")
    )


def candidate_visits(candidates: DataFrame) -> DataFrame:
    """The same collapse for candidate rows that already carry coordinates.
    Needs ``location_type`` and projected ``x``, ``y``."""
    return candidates.groupBy("location_type", "card_id", "stop_id", "region_code", "mode").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_ts").alias("first_ts"),
        F.min("stop_name").alias("stop_name"),
        F.min("x").alias("x"),
        F.min("y").alias("y"),
    )


def eligible_visits(visits: DataFrame, n: int = MIN_ROWS) -> DataFrame:
    """Visits of cards with at least ``n`` rows in each window (stop unknown included)."""

    def rows(kind: str) -> Column:
        return F.sum(F.when(F.col("location_type") == kind, F.col("n"))).over(Window.partitionBy("card_id"))

    counted = visits.withColumns({"_h": rows("residence"), "_w": rows("office")})
    return counted.where((F.col("_h") >= n) & (F.col("_w") >= n)).drop("_h", "_w")


# --- density clustering ---------------------------------------------------------------------

GROUP = ["location_type", "card_id"]


def _cluster_in_row(visits: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """Clusters of cards whose visits fit in one short array (at most
    ``SMALL_CARD`` elements), by array functions alone: one shuffle, no pairs
    leave the row.

    Visits are sorted by first use, so a cluster's label is the position of
    its first core visit and lower labels began earlier.
    """
    visit = F.struct(
        "first_ts", "stop_id", "region_code", "mode", "stop_name", "x", "y", "n"
    )
    cards = visits.groupBy(*GROUP).agg(F.sort_array(F.collect_list(visit)).alias("v"))
    near = cards.withColumn(
        "near",
        F.expr(
            f"""transform(v, p -> filter(sequence(0, size(v) - 1), j ->
                sqrt((p.x - v[j].x) * (p.x - v[j].x) + (p.y - v[j].y) * (p.y - v[j].y)) <= {float(eps)!r}D))"""
        ),
    )
    core = near.withColumn(
        "core", F.expr(f"transform(near, a -> aggregate(a, 0L, (s, j) -> s + v[j].n) >= {int(min_samples)})")
    ).where("exists(core, c -> c)")
    joined = core.withColumn("core_near", F.expr("transform(near, a -> filter(a, j -> core[j]))")).withColumn(
        "label",
        F.expr(
            """aggregate(sequence(0, size(v) - 1), transform(core, (c, i) -> if(c, i, -1)), (label, i) ->
                 if(core[i],
                    transform(array(transform(core_near[i], j -> label[j])),
                              seen -> transform(label, l -> if(array_contains(seen, l), array_min(seen), l)))[0],
                    label))"""
        ),
    )
    member = joined.withColumn(
        "member",
        F.expr("transform(core_near, (a, i) -> if(core[i], label[i], array_min(transform(a, j -> label[j]))))"),
    )
    main = member.withColumns(
        {
            "main": F.expr(
                """array_min(transform(array_distinct(filter(member, m -> m is not null)), m -> struct(
                     -aggregate(sequence(0, size(v) - 1), 0L, (s, i) -> s + if(member[i] <=> m, v[i].n, 0L)) as neg,
                     m as label)))"""
            ),
            "total_trips": F.expr("aggregate(v, 0L, (s, p) -> s + p.n)"),
        }
    )
    kept = F.expr(
        """filter(transform(v, (p, i) -> if(member[i] = main.label,
             struct(p.stop_id, p.stop_name, p.region_code, p.mode), null)), p -> p is not null)"""
    )
    return main.select(*GROUP, (-F.col("main.neg")).alias("cluster_size"), "total_trips", F.inline(kept))


def _points(visits: DataFrame, eps: float) -> DataFrame:
    """Distinct points of a card with their row weight and grid cell.

    The cell diagonal stays below ``eps``: all points of a cell are within
    reach of each other, so no pairs are formed inside a cell.
    """
    side = F.lit(eps / math.sqrt(2.0) * (1.0 - 1e-9))
    cell = F.struct(
        F.floor(F.col("x") / side).cast("bigint").alias("cx"), F.floor(F.col("y") / side).cast("bigint").alias("cy")
    )
    points = (
        visits.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy(*GROUP, "x", "y")
        .agg(
            F.sum("n").alias("w"),
            F.min(F.struct("first_ts", "stop_id", "region_code", "mode")).alias("first"),
        )
        .withColumn("cell", cell)
    )
    in_cell = Window.partitionBy(*GROUP, "cell")
    return points.withColumn("cell_w", F.sum("w").over(in_cell))


def _near_pairs(points: DataFrame, eps: float) -> DataFrame:
    """Pairs of points in different cells within ``eps``: each point looks
    into the 24 cells around its own, so work grows with the points and not
    with their square."""
    around = F.array(
        *[
            F.struct((F.col("cell.cx") + dx).alias("cx"), (F.col("cell.cy") + dy).alias("cy"))
            for dx in range(-2, 3)
            for dy in range(-2, 3)
            if (dx, dy) != (0, 0)
        ]
    )
    left = points.select(*GROUP, "x", "y", "cell", F.explode(around).alias("qcell"))
    right = points.select(
        *GROUP,
        F.col("x").alias("qx"),
        F.col("y").alias("qy"),
        F.col("w").alias("qw"),
        F.col("cell").alias("qcell"),
    )
    away = planar_distance(F.col("x"), F.col("y"), F.col("qx"), F.col("qy"))
    return left.join(right, [*GROUP, "qcell"]).where(away <= F.lit(eps))


def _components(edges: DataFrame) -> DataFrame:
    """Component (lowest cell) of every cell of a card: lowest label of the
    neighbours, then the label's own label, until nothing changes. Each round
    is checkpointed."""
    both = edges.select(*GROUP, F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(*GROUP, F.col("b").alias("node"), F.col("a").alias("other"))
    )
    labels = both.select(*GROUP, "node").distinct().withColumn("comp", F.col("node"))
    while True:
        seen = labels.select(*GROUP, F.col("node").alias("other"), F.col("comp").alias("ocomp"))
        lowest = (
            both.join(seen, [*GROUP, "other"])
            .groupBy(*GROUP, "node")
            .agg(F.min("ocomp").alias("low"))
        )
        hooked = labels.join(lowest, [*GROUP, "node"]).select(
            *GROUP, "node", F.col("comp").alias("was"), F.least("comp", "low").alias("comp")
        )
        jump = hooked.select(*GROUP, F.col("node").alias("comp"), F.col("comp").alias("up"))
        moved = cut(
            hooked.join(jump, [*GROUP, "comp"]).select(*GROUP, "node", "was", F.least("comp", "up").alias("comp"))
        )
        labels = moved.select(*GROUP, "node", "comp")
        if moved.where(F.col("was") != F.col("comp")).isEmpty():
            return labels


def _cluster_by_joins(visits: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """The same clusters for cards of any size, by equi joins on distance cells."""
    points = _points(visits, eps)
    pairs = cut(_near_pairs(points, eps))
    reach = pairs.groupBy(*GROUP, "x", "y").agg(F.sum("qw").alias("_near"))
    marked = cut(
        points.join(reach, [*GROUP, "x", "y"], "left")
        .withColumn("core", F.col("cell_w") + F.coalesce("_near", F.lit(0)) >= min_samples)
        .drop("_near")
    )
    core = marked.where("core")
    core_cells = core.groupBy(*GROUP, "cell").agg(F.min("first").alias("first"))

    p_core = core.select(*GROUP, "x", "y")
    q_core = core.select(*GROUP, F.col("x").alias("qx"), F.col("y").alias("qy"))
    to_core = pairs.join(q_core, [*GROUP, "qx", "qy"], "left_semi")
    links = (
        to_core.join(p_core, [*GROUP, "x", "y"], "left_semi")
        .where(F.col("cell") < F.col("qcell"))
        .select(*GROUP, F.col("cell").alias("a"), F.col("qcell").alias("b"))
    )
    alone = core_cells.select(*GROUP, F.col("cell").alias("a"), F.col("cell").alias("b"))
    edges = cut(links.unionByName(alone).distinct())

    comps = _components(edges)
    begun = (
        comps.join(core_cells.withColumnRenamed("cell", "node"), [*GROUP, "node"])
        .groupBy(*GROUP, "comp")
        .agg(F.min("first").alias("label"))
    )
    cell_labels = comps.join(begun, [*GROUP, "comp"]).select(*GROUP, F.col("node").alias("cell"), "label")

    # A core cell's points all lie within reach of its core points; other
    # points belong to the earliest cluster among the core points near them.
    inside = marked.select(*GROUP, "x", "y", "w", "cell").join(cell_labels, [*GROUP, "cell"]).select(
        *GROUP, "x", "y", "label", "w"
    )
    border = (
        to_core.join(marked.where(~F.col("core")).select(*GROUP, "x", "y", "w"), [*GROUP, "x", "y"])
        .join(cell_labels.withColumnRenamed("cell", "qcell"), [*GROUP, "qcell"])
        .select(*GROUP, "x", "y", "label", "w")
    )
    member = (
        inside.unionByName(border).groupBy(*GROUP, "x", "y").agg(F.min("label").alias("label"), F.first("w").alias("w"))
    )
    sizes = member.groupBy(*GROUP, "label").agg(F.sum("w").alias("cluster_size"))
    main = (
        sizes.groupBy(*GROUP)
        .agg(F.min(F.struct((-F.col("cluster_size")).alias("neg"), F.col("label"))).alias("m"))
        .select(*GROUP, F.col("m.label").alias("label"), (-F.col("m.neg")).alias("cluster_size"))
    )
    totals = marked.groupBy(*GROUP).agg(F.sum("w").alias("total_trips"))
    picked = (
        member.join(main, [*GROUP, "label"])
        .join(totals, GROUP)
        .select(*GROUP, "x", "y", "cluster_size", "total_trips")
    )
    return visits.join(picked, [*GROUP, "x", "y"]).select(
        *GROUP, "cluster_size", "total_trips", "stop_id", "stop_name", "region_code", "mode"
    )


def anchors_from_visits(
    visits: DataFrame, eps: float = EPS_METRES, min_samples: int = MIN_ROWS, small_card: int = SMALL_CARD
) -> DataFrame:
    """Stops of the largest density cluster of each (window, card).

    A visit counts by its rows, so the result equals clustering row by row.
    A visit is core when the rows within ``eps`` reach ``min_samples``; core
    visits within ``eps`` share a cluster; a border visit joins the cluster
    that began first; of equally large clusters the one that began first
    wins. Confidence is the cluster's share of the rows with coordinates,
    half-even to two digits.
    """
    located = visits.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    sized = cut(located.withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy("card_id"))))
    found = _cluster_in_row(sized.where(F.col("_m") <= small_card).drop("_m"), eps, min_samples)
    large = sized.where(F.col("_m") > small_card).drop("_m")
    if not large.isEmpty():
        found = found.unionByName(_cluster_by_joins(large, eps, min_samples))
    return found.select(
        "card_id",
        "stop_id",
        "stop_name",
        "region_code",
        F.col("mode").alias("transport_type"),
        "location_type",
        half_even(F.col("cluster_size") / F.col("total_trips"), 2).alias("confidence"),
        "cluster_size",
        "total_trips",
    )


def anchors(
    candidates: DataFrame, eps: float = EPS_METRES, min_samples: int = MIN_ROWS, small_card: int = SMALL_CARD
) -> DataFrame:
    """Anchors from candidate rows (``location_type``, card, stop key,
    ``stop_name``, ``event_ts``, projected ``x``, ``y``)."""
    return anchors_from_visits(candidate_visits(candidates), eps, min_samples, small_card)


def all_anchors(residence: DataFrame, office: DataFrame) -> DataFrame:
    return residence.unionByName(office)


def anchor_stats(found: DataFrame) -> DataFrame:
    def of(kind: str) -> Column:
        return F.count(F.when(F.col("location_type") == kind, 1))

    return found.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("card_id").alias("unique_cards"),
        of("residence").alias("residence_rows"),
        of("office").alias("work_rows"),
    )


# --- modal cells -----------------------------------------------------------------------------


def modal_cell(df: DataFrame, card: str, cell: str, ts: str, window: tuple[int, int], name: str) -> DataFrame:
    """Most used cell of a card within an hour window; ties all stay, and an
    unknown cell competes like any other."""
    counts = df.where(hour_in(F.col(ts), *window)).groupBy(card, F.col(cell).alias(name)).agg(F.count(F.lit(1)).alias("freq"))
    rank = F.rank().over(Window.partitionBy(card).orderBy(F.col("freq").desc()))
    return counts.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


CELL_WINDOWS = {
    "am_dep": ("board", CELL_AM_HOURS),
    "pm_arr": ("alight", PM_HOURS),
    "am_arr": ("alight", CELL_AM_HOURS),
    "pm_dep": ("board", PM_HOURS),
}


def modal_cells(tagged: DataFrame, am: tuple[int, int] = CELL_AM_HOURS, pm: tuple[int, int] = PM_HOURS) -> DataFrame:
    """All four window modes in one pass: (card, win, cell, freq), ties kept.

    Each trip is read once and fans out to the windows it falls into.
    """
    hours = {"am_dep": am, "pm_arr": pm, "am_arr": am, "pm_dep": pm}
    hits = [
        F.when(
            hour_in(F.col(f"{end}_ts"), *hours[win]),
            F.struct(F.lit(win).alias("win"), F.col(f"{end}_cell").alias("cell")),
        )
        for win, (end, _) in CELL_WINDOWS.items()
    ]
    counts = (
        tagged.select("card_id", F.inline(F.array_compact(F.array(*hits))))
        .groupBy("card_id", "win", "cell")
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    rank = F.rank().over(Window.partitionBy("card_id", "win").orderBy(F.col("freq").desc()))
    return counts.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def with_cells(trips: DataFrame, stops: DataFrame, cell: str = "cell_id") -> DataFrame:
    """Trips with the cell of both ends (``board_cell``, ``alight_cell``)."""
    dim = stops.withColumnRenamed(cell, "cell") if cell != "cell" else stops
    return enrich_stops(trips, dim, ["cell"])


def agreed_cells(modes: DataFrame) -> DataFrame:
    """Home = a cell that is modal both for morning departures and evening
    arrivals; work = modal both for morning arrivals and evening departures.
    Ties collapse to the lowest cell; cards lacking either drop out.

    Per card the four mode sets are intersected instead of joined, so tied
    modes never multiply. A card without a morning departure has no home.
    """

    def modal(win: str) -> Column:
        return F.collect_set(F.when(F.col("win") == win, F.col("cell")))

    sets = modes.groupBy("card_id").agg(*[modal(w).alias(w) for w in CELL_WINDOWS])
    return sets.select(
        "card_id",
        F.array_min(F.array_intersect("am_dep", "pm_arr")).alias("home_cell"),
        F.array_min(F.array_intersect("am_arr", "pm_dep")).alias("work_cell"),
    ).where(F.col("home_cell").isNotNull() & F.col("work_cell").isNotNull())


def anchor_cells(trips: DataFrame, stops: DataFrame, cell: str = "cell_id") -> DataFrame:
    """Home and work cell per card by agreement of morning and evening modes."""
    return agreed_cells(modal_cells(with_cells(trips, stops, cell)))
