"""Bilinear and nearest resampling between pixel grids.

Each target cell is mapped to a fractional source position by column arithmetic and
asks for its four neighbours by key; weights are renormalised where neighbours are
missing. Targets and sources meet in a plain equi-join and one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracover.operators.joins import large_join
from terracover.operators.projection import with_lonlat, with_utm


def bilinear(targets: DataFrame, source: DataFrame, keys, bands) -> DataFrame:
    """Weighted mean of the four source cells around ``(src_r, src_c)`` of each target.

    ``targets``: keys, r, c, src_r, src_c (cell units, centres at +0.5). ``source``: one
    row per keys, r, c. Target cells without any neighbour are left out.
    """
    keys = list(keys)
    r0, c0 = F.floor(F.col("src_r") - 0.5), F.floor(F.col("src_c") - 0.5)
    fr, fc = F.col("src_r") - 0.5 - F.col("r0"), F.col("src_c") - 0.5 - F.col("c0")
    corners = [
        F.struct(
            (F.col("r0") + dr).cast("int").alias("r"),
            (F.col("c0") + dc).cast("int").alias("c"),
            ((fr if dr else 1 - fr) * (fc if dc else 1 - fc)).alias("w"),
        )
        for dr in (0, 1)
        for dc in (0, 1)
    ]
    wanted = (
        targets.withColumns({"r0": r0, "c0": c0})
        .select(*keys, F.col("r").alias("t_r"), F.col("c").alias("t_c"), F.explode(F.array(*corners)).alias("n"))
        .where("n.w > 0")
        .select(*keys, "t_r", "t_c", "n.r", "n.c", "n.w")
    )
    joined = large_join(wanted, source.select(*keys, "r", "c", *bands), [*keys, "r", "c"])
    mean = lambda b: F.sum(F.col("w") * F.col(b)) / F.sum(F.when(F.col(b).isNotNull(), F.col("w")))
    return (
        joined.groupBy(*keys, "t_r", "t_c")
        .agg(*(mean(b).alias(b) for b in bands))
        .withColumnsRenamed({"t_r": "r", "t_c": "c"})
    )


def nearest(targets: DataFrame, source: DataFrame, keys, bands) -> DataFrame:
    """Value of the source cell under ``(src_r, src_c)`` of each target: for class bands.

    Target cells over a missing source cell are left out.
    """
    keys = list(keys)
    under = targets.select(
        *keys, F.col("r").alias("t_r"), F.col("c").alias("t_c"),
        F.floor("src_r").cast("int").alias("r"), F.floor("src_c").cast("int").alias("c"),
    )
    joined = large_join(under, source.select(*keys, "r", "c", *bands), [*keys, "r", "c"])
    return joined.select(*keys, F.col("t_r").alias("r"), F.col("t_c").alias("c"), *bands)


def scaled_targets(extent: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Target cells of a grid resized by ``numerator / denominator`` over the same area."""
    size = lambda c: F.expr(f"CAST(greatest(1, {c} * {numerator} DIV {denominator}) AS INT)")
    grids = extent.withColumns({"t_height": size("height"), "t_width": size("width")})
    rows = grids.select("*", F.explode(F.expr("sequence(0, t_height - 1)")).alias("r")).repartition("zone", "r")
    cells = rows.select("*", F.explode(F.expr("sequence(0, t_width - 1)")).alias("c"))
    place = lambda i, size, t_size: (F.col(i) + F.lit(0.5)) * F.col(size) / F.col(t_size)
    return cells.select(
        "zone", "r", "c",
        place("r", "height", "t_height").alias("src_r"),
        place("c", "width", "t_width").alias("src_c"),
    )


def geographic_grid(scenes: DataFrame, keys) -> DataFrame:
    """Geographic grid covering each UTM scene, with about the same number of cells.

    ``scenes``: keys plus utm_zone, south, east0, north0, pixel (metres), height, width.
    Adds lon0, lat0, step, t_height, t_width. The bounds are those of the four projected
    corners, cells are square, and the diagonal keeps its number of cells.
    """
    keys = list(keys)
    east1 = F.col("east0") + F.col("pixel") * F.col("width")
    north1 = F.col("north0") - F.col("pixel") * F.col("height")
    corner = lambda e, n: F.struct(e.alias("corner_e"), n.alias("corner_n"))
    corners = F.array(*(corner(e, n) for e in (F.col("east0"), east1) for n in (F.col("north0"), north1)))
    placed = with_lonlat(scenes.select("*", F.inline(corners)), "corner_e", "corner_n")
    rest = [c for c in scenes.columns if c not in keys]
    bounded = placed.groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in rest),
        F.min("lon").alias("lon0"), F.max("lon").alias("lon1"),
        F.max("lat").alias("lat0"), F.min("lat").alias("lat1"),
    )
    wide, high = F.col("lon1") - F.col("lon0"), F.col("lat0") - F.col("lat1")
    cells = F.sqrt((F.col("height") * F.col("height") + F.col("width") * F.col("width")).cast("double"))
    size = lambda span: F.greatest(F.lit(1), F.floor(span / F.col("step") + 0.5)).cast("int")
    return (
        bounded.withColumn("step", F.sqrt(wide * wide + high * high) / cells)
        .withColumns({"t_width": size(wide), "t_height": size(high)})
        .drop("lon1", "lat1")
    )


def reprojected_targets(grids: DataFrame, keys) -> DataFrame:
    """Cells of ``geographic_grid`` with their fractional position in the UTM scene."""
    keys = list(keys)
    rows = grids.select("*", F.explode(F.expr("sequence(0, t_height - 1)")).alias("r")).repartition(*keys, "r")
    cells = rows.select("*", F.explode(F.expr("sequence(0, t_width - 1)")).alias("c")).withColumns({
        "x": F.col("lon0") + F.col("step") * (F.col("c") + 0.5),
        "y": F.col("lat0") - F.col("step") * (F.col("r") + 0.5),
    })
    return with_utm(cells, "x", "y").select(
        *keys, "r", "c", "x", "y",
        ((F.col("north0") - F.col("north")) / F.col("pixel")).alias("src_r"),
        ((F.col("east") - F.col("east0")) / F.col("pixel")).alias("src_c"),
    )


def stack_bands(long: DataFrame, keys, bands, band: str = "band", value: str = "value") -> DataFrame:
    """One column per band from one row per band; the band list is explicit, so one pass."""
    pick: dict[str, Column] = {b: F.max(F.when(F.col(band) == b, F.col(value))) for b in bands}
    return long.groupBy(*keys).agg(*(expr.alias(b) for b, expr in pick.items()))
