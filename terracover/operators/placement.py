"""Polygon layers in a reference of their own, placed on zone grids.

Vertices come in geographic degrees (EPSG 4326) or in UTM metres (EPSG 326zz, 327zz), grids
have an EPSG code and an affine transform. A straight edge is a curve in another reference,
so edges are cut into short pieces first, each end is transformed by itself, and the inverse
affine transform turns it into cell units, which the scanline code takes. Ends shared by two
pieces come from the same expression of the same values, so rings stay closed without a join.

A polygon may have several rings (``ring``); cells inside an even number of them are holes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracover.operators.joins import lookup_join
from terracover.operators.polygons import polygon_cells, polygon_edges
from terracover.operators.projection import with_lonlat, with_utm

# EPSG codes and the length of a degree that scales the cutting of edges.
GEOGRAPHIC = 4326
UTM_NORTH, UTM_SOUTH = 32600, 32700
METRES_PER_DEGREE = 111320.0

PART_OF = ("zone", "layer", "poly_id", "ring")
AFFINE = ("a", "b", "c", "d", "e", "f")


def _utm(epsg: Column) -> tuple[Column, Column]:
    """UTM zone number and hemisphere of a code; NULL for the geographic one, an error for others."""
    south = epsg.between(UTM_SOUTH + 1, UTM_SOUTH + 60)
    known = F.when(epsg.between(UTM_NORTH + 1, UTM_NORTH + 60) | south, epsg % 100).when(epsg != GEOGRAPHIC, F.raise_error(
        F.concat(F.lit("unknown reference EPSG:"), epsg.cast("string"))
    ).cast("int"))
    return known, south


def change_crs(df: DataFrame, x: str, y: str, source: str, target: str, to_x: str, to_y: str) -> DataFrame:
    """Add ``to_x`` and ``to_y``: the point in the reference of the code column ``target``.

    Points whose references are equal keep their values exactly.
    """
    kept = [F.col(c) for c in df.columns]
    zone, south = _utm(F.col(source))
    step = df.withColumns({"utm_zone": zone, "south": south, "_x": F.col(x), "_y": F.col(y)})
    step = with_lonlat(step, "_x", "_y", "_lon", "_lat")
    plain = F.col(source) == GEOGRAPHIC
    step = step.withColumns({"_lon": F.when(plain, F.col(x)).otherwise(F.col("_lon")), "_lat": F.when(plain, F.col(y)).otherwise(F.col("_lat"))})
    zone, south = _utm(F.col(target))
    step = with_utm(step.withColumns({"utm_zone": zone, "south": south}), "_lon", "_lat", "_east", "_north")
    same, degrees = F.col(source) == F.col(target), F.col(target) == GEOGRAPHIC

    def moved(own: str, geographic: str, metric: str) -> Column:
        return F.when(same, F.col(own)).when(degrees, F.col(geographic)).otherwise(F.col(metric))

    return step.select(*kept, moved(x, "_lon", "_east").alias(to_x), moved(y, "_lat", "_north").alias(to_y))


def cut_edges(edges: DataFrame, pieces: Column) -> DataFrame:
    """Every edge as ``pieces`` equal ones, numbered by ``part``."""
    along = lambda k, start, end: F.when(F.col(k) == F.col("n"), F.col(end)).otherwise(
        F.col(start) + (F.col(end) - F.col(start)) * F.col(k) / F.col("n")
    )
    rest = [c for c in edges.columns if c not in ("x1", "y1", "x2", "y2")]
    cut = edges.withColumn("n", pieces.cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return cut.withColumn("next", F.col("part") + 1).select(
        *rest, "part", along("part", "x1", "x2").alias("x1"), along("part", "y1", "y2").alias("y1"),
        along("next", "x1", "x2").alias("x2"), along("next", "y1", "y2").alias("y2"),
    )


def place_edges(vertices: DataFrame, grids: DataFrame, longest: float = 4.0) -> DataFrame:
    """Edges of the rings in cell units of their zone's grid (x = column, y = row).

    ``vertices``: zone, layer, poly_id, ring, seq, x, y, epsg. ``grids``, a stored table: zone,
    height, width, grid_epsg and the affine terms a to f: ``x = a * column + b * row + c`` and
    ``y = d * column + e * row + f``. Pieces are at most about ``longest`` cells long; edges in the grid's own reference stay
    whole. Zones without a grid have no edges.
    """
    edges = polygon_edges(vertices, ring=(*PART_OF, "epsg"))
    placed = lookup_join(edges, grids.select("zone", "grid_epsg", *AFFINE), "zone")
    cell = F.greatest(F.abs("a"), F.abs("b"), F.abs("d"), F.abs("e"))
    metric, degrees = F.col("grid_epsg") != GEOGRAPHIC, F.col("epsg") == GEOGRAPHIC
    unit = cell * F.when(metric & degrees, 1 / METRES_PER_DEGREE).when(~metric & ~degrees, METRES_PER_DEGREE).otherwise(1.0)
    length = F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))
    pieces = F.when(F.col("epsg") == F.col("grid_epsg"), 1).otherwise(F.greatest(F.lit(1), F.ceil(length / (unit * longest))))
    short = cut_edges(placed, pieces)
    for end in ("1", "2"):
        short = change_crs(short, f"x{end}", f"y{end}", "epsg", "grid_epsg", f"_gx{end}", f"_gy{end}")
    area = F.col("a") * F.col("e") - F.col("b") * F.col("d")

    def cells(end: str) -> dict[str, Column]:
        dx, dy = F.col(f"_gx{end}") - F.col("c"), F.col(f"_gy{end}") - F.col("f")
        return {f"x{end}": (F.col("e") * dx - F.col("b") * dy) / area, f"y{end}": (F.col("a") * dy - F.col("d") * dx) / area}

    ends = {**cells("1"), **cells("2")}
    return short.select(*PART_OF, "seq", "part", *[c.alias(name) for name, c in ends.items()])


def place_layers(vertices: DataFrame, grids: DataFrame, longest: float = 4.0) -> DataFrame:
    """Distinct cells (zone, layer, r, c) of the layers on their zones' grids."""
    return polygon_cells(place_edges(vertices, grids, longest), grids.select("zone", "height", "width"))
