"""Projection to EPSG:5179 and the 12-character national grid cell."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# GRS80 ellipsoid and the parameters of EPSG:5179.
SEMI_MAJOR = 6378137.0
FLATTENING = 1.0 / 298.257222101
LAT0_DEG = 38.0
LON0_DEG = 127.5
SCALE = 0.9996
FALSE_EAST = 1000000.0
FALSE_NORTH = 2000000.0

# Grid letters per 100 km step, first steps, and local letters.
GRID_X_LETTERS = "ABCDEFG"
GRID_Y_LETTERS = "BCDEFGH"
GRID_X_FIRST = 7
GRID_Y_FIRST = 14
GRID_STEP = 100000
LOCAL_FROM = "ABCDEFGH"
LOCAL_TO = "가나다라마바사아"

E2 = FLATTENING * (2.0 - FLATTENING)
EP2 = E2 / (1.0 - E2)
# Meridian-arc series coefficients (Snyder 1987, eq. 3-21).
ARC = (
    1.0 - E2 / 4.0 - 3.0 * E2**2 / 64.0 - 5.0 * E2**3 / 256.0,
    3.0 * E2 / 8.0 + 3.0 * E2**2 / 32.0 + 45.0 * E2**3 / 1024.0,
    15.0 * E2**2 / 256.0 + 45.0 * E2**3 / 1024.0,
    35.0 * E2**3 / 3072.0,
)
LAT0 = math.radians(LAT0_DEG)
ARC0 = SEMI_MAJOR * (
    ARC[0] * LAT0 - ARC[1] * math.sin(2 * LAT0) + ARC[2] * math.sin(4 * LAT0) - ARC[3] * math.sin(6 * LAT0)
)


def project(df: DataFrame, lon: str, lat: str, x_out: str = "x_5179", y_out: str = "y_5179") -> DataFrame:
    """Add projected metres (transverse Mercator, Snyder 1987 eq. 8-9 and 8-10)."""
    terms = df.selectExpr(
        "*",
        f"radians(`{lat}`) AS _p",
        f"tan(radians(`{lat}`)) AS _tan",
        f"{SEMI_MAJOR!r}D / sqrt(1D - {E2!r}D * pow(sin(radians(`{lat}`)), 2)) AS _n",
        f"{EP2!r}D * pow(cos(radians(`{lat}`)), 2) AS _c",
        f"radians(`{lon}` - {LON0_DEG!r}D) * cos(radians(`{lat}`)) AS _a",
    ).selectExpr("*", "_tan * _tan AS _t", "_a * _a AS _a2")
    arc = " ".join(
        f"{sign} {c!r}D * {f'sin({k}D * _p)' if k else '_p'}" for sign, c, k in zip("+-+-", ARC, (0, 2, 4, 6))
    )
    east = f"""_a * (1D + _a2 * (1D - _t + _c) / 6D
        + _a2 * _a2 * (5D - 18D * _t + _t * _t + 72D * _c - {58 * EP2!r}D) / 120D)"""
    north = f"""{SEMI_MAJOR!r}D * (0D {arc}) - {ARC0!r}D + _n * _tan * _a2 * (0.5D
        + _a2 * (5D - _t + 9D * _c + 4D * _c * _c) / 24D
        + _a2 * _a2 * (61D - 58D * _t + _t * _t + 600D * _c - {330 * EP2!r}D) / 720D)"""
    return terms.selectExpr(
        *[f"`{c}`" for c in df.columns if c not in (x_out, y_out)],
        f"{FALSE_EAST!r}D + {SCALE!r}D * _n * ({east}) AS `{x_out}`",
        f"{FALSE_NORTH!r}D + {SCALE!r}D * ({north}) AS `{y_out}`",
    )


def grid_cell(x: Column, y: Column) -> Column:
    """Two letters for the 100 km square (clipped to the covered area) and
    five metre digits per axis."""

    def letter(metres: Column, first: int, letters: str) -> Column:
        step = F.floor(metres / float(GRID_STEP)).cast("int") - first
        clipped = F.greatest(F.lit(0), F.least(F.lit(len(letters) - 1), step))
        return F.substring(F.lit(letters), clipped + 1, F.lit(1))

    def digits(metres: Column) -> Column:
        return F.lpad((F.floor(F.abs(metres)) % GRID_STEP).cast("string"), 5, "0")

    known = x.isNotNull() & y.isNotNull()
    return F.when(
        known,
        F.concat(
            letter(x, GRID_X_FIRST, GRID_X_LETTERS),
            letter(y, GRID_Y_FIRST, GRID_Y_LETTERS),
            digits(x),
            digits(y),
        ),
    )


def grid_metres(cell: Column) -> tuple[Column, Column]:
    """Metres of a cell id; both NULL when the id is malformed."""
    xi = F.instr(F.lit(GRID_X_LETTERS), F.substring(cell, 1, 1))
    yi = F.instr(F.lit(GRID_Y_LETTERS), F.substring(cell, 2, 1))
    digits = cell.rlike("^.{2}[0-9]{10,}$")
    ok = digits & (xi > 0) & (yi > 0)
    x_tail = F.substring(cell, 3, 5).try_cast("bigint")
    y_tail = F.substring(cell, F.lit(8), F.length(cell)).try_cast("bigint")
    x = (xi - 1 + GRID_X_FIRST).cast("bigint") * GRID_STEP + x_tail
    y = (yi - 1 + GRID_Y_FIRST).cast("bigint") * GRID_STEP + y_tail
    return F.when(ok, x), F.when(ok, y)


def point_wkt(x: Column, y: Column) -> Column:
    return F.when(
        x.isNotNull() & y.isNotNull(),
        F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")")),
    )


def grid_wkt(cell: Column) -> Column:
    return point_wkt(*grid_metres(cell))


def local_grid(cell: Column) -> Column:
    """The same cell in the national script."""
    return F.translate(cell, LOCAL_FROM, LOCAL_TO)


def rectangle_wkt(lon_min: Column, lat_min: Column, lon_max: Column, lat_max: Column) -> Column:
    """Closed ring from the lower-left corner upwards, six decimals."""

    def corner(lon: Column, lat: Column) -> Column:
        return F.format_string("%.6f %.6f", lon, lat)

    ring = [
        corner(lon_min, lat_min),
        corner(lon_min, lat_max),
        corner(lon_max, lat_max),
        corner(lon_max, lat_min),
        corner(lon_min, lat_min),
    ]
    known = lon_min.isNotNull() & lat_min.isNotNull() & lon_max.isNotNull() & lat_max.isNotNull()
    return F.when(known, F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *ring), F.lit("))")))


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))
