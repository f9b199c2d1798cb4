"""Polygon layers to grid cells by scanline filling.

A cell belongs to a polygon when its centre ``(c + 0.5, r + 0.5)`` is inside by the
half-open even-odd rule. Edges are cut at the row centres they cross, crossings are
reduced to their parity per start column, and consecutive odd crossings delimit spans.
Work follows the outline and the filled area; pixels are never joined with edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracover.operators.joins import large_join, lookup_join
from terracover.sources.staging import stage

RING = ("zone", "layer", "poly_id")


def polygon_edges(vertices: DataFrame, ring=RING) -> DataFrame:
    """Closed edges from vertices numbered 0, 1, 2, ... within each ring.

    Each vertex meets its successor by key and sequence number, and the closing edge is a
    combinable aggregate, so a ring with very many vertices is spread like any other.
    """
    ring = list(ring)
    following = vertices.select(
        *ring, (F.col("seq") - 1).alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2")
    )
    start = vertices.select(*ring, "seq", F.col("x").alias("x1"), F.col("y").alias("y1"))
    body = large_join(start, following, [*ring, "seq"])
    ends = vertices.groupBy(*ring).agg(
        F.max_by(F.struct("x", "y"), "seq").alias("last"),
        F.min_by(F.struct("x", "y"), "seq").alias("first"),
        F.max("seq").alias("seq"),
    )
    closing = ends.select(
        *ring, "seq",
        F.col("last.x").alias("x1"), F.col("last.y").alias("y1"),
        F.col("first.x").alias("x2"), F.col("first.y").alias("y2"),
    )
    return body.unionByName(closing)


def layer_spans(edges: DataFrame, extent: DataFrame, ring=RING) -> DataFrame:
    """Half-open column spans ``[c_from, c_to)`` of every polygon row inside its zone grid.

    ``extent`` (zone, height, width) should be a stored table. Broadcasting it keeps a
    zone with most polygons from skewing the join. Only grid rows are unfolded, and
    crossings beside the grid count at its border, which leaves their parity unchanged.
    """
    ring = list(ring)
    first_row = F.greatest(F.lit(0), F.ceil(F.least("y1", "y2") - 0.5))
    last_row = F.least(F.col("height") - 1, F.ceil(F.greatest("y1", "y2") - 0.5) - 1)
    centre = F.col("r") + F.lit(0.5)
    x_cross = (F.col("x2") - F.col("x1")) * (centre - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    start = F.least(F.greatest(F.ceil(x_cross - F.lit(0.5)), F.lit(0)), "width")
    crossings = (
        lookup_join(edges, extent, "zone")
        .where(first_row <= last_row)
        .withColumn("r", F.explode(F.sequence(first_row.cast("int"), last_row.cast("int"))))
        .select(*ring, "r", start.cast("int").alias("c_from"))
        .groupBy(*ring, "r", "c_from")
        .agg((F.count(F.lit(1)) % 2).alias("odd"))
        .where("odd = 1")
    )
    # Parity leaves at most one row per column, so a window group is at most a grid row.
    along = Window.partitionBy(*ring, "r").orderBy("c_from")
    return (
        crossings.select(
            *ring, "r", "c_from",
            F.lead("c_from").over(along).alias("c_to"),
            F.row_number().over(along).alias("k"),
        )
        .where("k % 2 = 1")
        .select(*ring, "r", "c_from", "c_to")
    )


def polygon_cells(edges: DataFrame, extent: DataFrame, ring=RING) -> DataFrame:
    """Distinct grid cells per layer; overlapping polygons dissolve."""
    return (
        layer_spans(edges, extent, ring)
        .select("zone", "layer", "r", F.explode(F.expr("sequence(c_from, c_to - 1)")).alias("c"))
        .distinct()
    )


def grid_cells(extent: DataFrame) -> DataFrame:
    """Every cell of every zone grid; rows are redistributed before columns unfold."""
    rows = extent.select("zone", "width", F.explode(F.expr("sequence(0, height - 1)")).alias("r"))
    return rows.repartition("zone", "r").select(
        "zone", "r", F.explode(F.expr("sequence(0, width - 1)")).alias("c")
    )


def clip_to_layer(px: DataFrame, edges: DataFrame, extent: DataFrame, layer: str = "perimeter") -> DataFrame:
    """Pixels whose cell centre lies in the layer.

    Pixels meet row spans, not cells. The few spans per grid row are staged and broadcast
    when their count allows; otherwise the semi join splits skewed rows.
    """
    spans = stage(
        layer_spans(edges.where(F.col("layer") == layer), extent).select(
            F.col("zone").alias("s_zone"), F.col("r").alias("s_r"), "c_from", "c_to"
        ),
        "spans",
    )
    inside = (
        (px["zone"] == spans["s_zone"]) & (px["r"] == spans["s_r"])
        & (px["c"] >= spans["c_from"]) & (px["c"] < spans["c_to"])
    )
    return lookup_join(px, spans, inside, "left_semi")


def clip_outcome(px: DataFrame, edges: DataFrame, extent: DataFrame, scene, layer: str = "perimeter") -> DataFrame:
    """Clipped pixels and ``no_overlap``: a scene without a pixel in the layer stays whole and is flagged.

    ``scene``: the key columns of a scene.
    """
    scene = list(scene)
    clipped = clip_to_layer(px, edges, extent, layer)
    met = stage(clipped.select(*scene).distinct(), "overlapping")
    missed = lookup_join(px, met, scene, "left_anti", null_safe=True)
    return clipped.withColumn("no_overlap", F.lit(False)).unionByName(missed.withColumn("no_overlap", F.lit(True)))


def clip_reduction(px: DataFrame, clipped: DataFrame) -> DataFrame:
    """Cells before and after clipping and the reduction in percent, per zone."""
    cells = lambda df, name: df.select("zone", "r", "c").distinct().groupBy("zone").agg(
        F.count(F.lit(1)).alias(name)
    )
    return (
        cells(px, "n_original").join(cells(clipped, "n_clipped"), "zone", "left")
        .withColumn("n_clipped", F.coalesce("n_clipped", F.lit(0)).cast("bigint"))
        .withColumn("reduction_pct", (1 - F.col("n_clipped") / F.col("n_original")) * 100)
    )
