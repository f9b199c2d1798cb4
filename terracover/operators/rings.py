"""Cell sets dissolved to rings: the outline of a union of polygons, without geometry code.

Every cell has four directed edges with its area on the right; edges of neighbours run
against each other and cancel in one aggregation. What is left is joined to straight
segments, each segment to the one that starts where it ends, and the cycles are numbered by
pointer doubling. Where two cells touch at a corner only, the right turn keeps them apart.
In coordinates x = column, y = row, outer rings have a positive area and holes a negative one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracover.operators.chains import cycle_heads, cycle_places
from terracover.operators.joins import large_join
from terracover.operators.polygons import polygon_edges
from terracover.sources.staging import stage

KEYS = ("zone", "layer")
# Directions clockwise, as areas are on the right.
EAST, SOUTH, WEST, NORTH = range(4)


def boundary_edges(cells: DataFrame, keys=KEYS) -> DataFrame:
    """Unit edges (keys, heading, line, at) of distinct cells that have no neighbour beyond them.

    Horizontal edges lie on the grid line ``line`` = y from x = ``at``, vertical ones on
    x = ``line`` from y = ``at``.
    """
    r, c = F.col("r"), F.col("c")
    side = lambda level, heading, line, at: F.struct(
        F.lit(level).alias("level"), F.lit(heading).alias("heading"), line.cast("int").alias("line"), at.cast("int").alias("at")
    )
    sides = F.array(side(True, EAST, r, c), side(False, SOUTH, c + 1, r), side(True, WEST, r + 1, c), side(False, NORTH, c, r))
    edges = cells.select(*keys, F.explode(sides).alias("e")).select(*keys, "e.*")
    alone = edges.groupBy(*keys, "level", "line", "at").agg(F.count(F.lit(1)).alias("n"), F.min("heading").alias("heading")).where("n = 1")
    return alone.select(*keys, "heading", "line", "at")


def segments(edges: DataFrame, keys=KEYS) -> DataFrame:
    """Straight segments (keys, heading, x1, y1, x2, y2) between corners; a window holds one grid line."""
    order = Window.partitionBy(*keys, "heading", "line").orderBy("at")
    runs = edges.withColumn("run", F.col("at") - F.row_number().over(order)).groupBy(*keys, "heading", "line", "run").agg(
        F.min("at").alias("low"), (F.max("at") + 1).alias("high")
    )
    level, forward = F.col("heading") % 2 == 0, F.col("heading").isin(EAST, SOUTH)
    start, end = F.when(forward, F.col("low")).otherwise(F.col("high")), F.when(forward, F.col("high")).otherwise(F.col("low"))
    place = lambda along: (F.when(level, along).otherwise(F.col("line")), F.when(level, F.col("line")).otherwise(along))
    (x1, y1), (x2, y2) = place(start), place(end)
    return runs.select(*keys, "heading", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def dissolved_rings(cells: DataFrame, keys=KEYS) -> DataFrame:
    """Vertices (keys, ring, seq, x, y) of the outlines of distinct cells; ``ring`` is unique per key.

    Rings start at their topmost leftmost segment; ``ring`` is made of its corner and heading.
    """
    keys = list(keys)
    numbered = stage(segments(boundary_edges(cells, keys), keys).withColumn("id", F.monotonically_increasing_id()), "segments")
    after = numbered.select(*keys, F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("heading").alias("turned"), F.col("id").alias("next"))
    right = F.col("turned") == (F.col("heading") + 1) % 4
    linked = large_join(numbered, after, [*keys, "x2", "y2"]).groupBy("id").agg(F.max(F.struct(right.alias("right"), "next")).alias("to"))
    mark = F.shiftleft(F.col("y1").cast("long"), 34) + F.shiftleft(F.col("x1").cast("long"), 2) + F.col("heading")
    links = stage(large_join(numbered.select("id", mark.alias("mark")), linked, "id").select("id", "to.next", "mark"), "links")
    placed = cycle_places(stage(cycle_heads(links), "heads"))
    met = large_join(numbered, placed, "id")
    return met.select(*keys, F.col("head").alias("ring"), F.col("place").cast("int").alias("seq"), F.col("x1").cast("double").alias("x"), F.col("y1").cast("double").alias("y"))


def ring_edges(vertices: DataFrame, keys=KEYS) -> DataFrame:
    """Edges of traced rings for the scanline code: all rings of a key are one polygon, so holes stay open."""
    return polygon_edges(vertices, ring=[*keys, "ring"]).withColumn("poly_id", F.lit(0))


def ring_measures(vertices: DataFrame, keys=KEYS) -> DataFrame:
    """Per ring: number of corners, perimeter and signed area in cells."""
    edges = ring_edges(vertices, keys)
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    length = F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1"))
    return edges.groupBy(*keys, "ring").agg(
        F.count(F.lit(1)).alias("n_corners"), F.sum(length).cast("long").alias("perimeter"), (F.sum(cross) / 2).cast("long").alias("area")
    )
