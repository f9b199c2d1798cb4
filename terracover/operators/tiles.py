"""Pixel tables as tiled blocks: square arrays per band, as scene rasters store them.

A tile's cells are sorted by their place in it and the gaps between them filled with nodata;
tiles at the border of a grid are padded to full size. A group holds at most ``size * size``
cells, a bound that does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracover.sources.readers import raster_to_pixels

SIZE = 256


def pixels_to_blocks(px: DataFrame, keys, bands, size: int = SIZE, nodata: float = 0.0) -> DataFrame:
    """One row per tile that has a pixel: keys, ``tile_r``, ``tile_c``, a row-major array per band.

    ``px`` has one row per cell; two of them are an error. Missing cells are nodata, a NULL
    reading of a present cell stays NULL. Cell addresses start at 0.
    """
    keys, bands = list(keys), list(bands)
    place = (F.col("r") % size) * size + F.col("c") % size
    tile = [F.expr(f"CAST(r DIV {size} AS INT)").alias("tile_r"), F.expr(f"CAST(c DIV {size} AS INT)").alias("tile_c")]
    rows = px.select(*keys, *tile, place.cast("int").alias("at"), *(F.col(b).cast("double").alias(b) for b in bands))
    cells = F.sort_array(F.collect_list(F.struct("at", *bands)))
    tiles = rows.groupBy(*keys, "tile_r", "tile_c").agg(cells.alias("cells"))
    empty = F.struct(F.lit(-1).alias("at"), *(F.lit(nodata).cast("double").alias(b) for b in bands))

    def with_gap(cell: Column, i: Column) -> Column:
        gap = cell["at"] - F.when(i == 0, -1).otherwise(F.get("cells", i - 1)["at"]) - 1
        checked = F.when(gap < 0, F.raise_error(F.lit("more than one pixel in a cell")).cast("int")).otherwise(gap)
        return F.concat(F.array_repeat(empty, checked), F.array(cell))

    rest = F.array_repeat(empty, F.lit(size * size - 1) - F.element_at("cells", -1)["at"])
    filled = tiles.withColumn("cells", F.concat(F.flatten(F.transform("cells", with_gap)), rest))
    return filled.select(*keys, "tile_r", "tile_c", *(F.col("cells").getField(b).alias(b) for b in bands))


def blocks_to_pixels(blocks: DataFrame, keys, bands, size: int = SIZE, nodata: float | None = 0.0) -> DataFrame:
    """Pixels of tiles by their address in the whole grid; nodata of the first band is dropped."""
    keys = list(keys)
    inside = raster_to_pixels(blocks, [*keys, "tile_r", "tile_c"], list(bands), size, nodata)
    return inside.select(
        *keys, (F.col("tile_r") * size + F.col("r")).alias("r"), (F.col("tile_c") * size + F.col("c")).alias("c"), *bands
    )


def block_sums(blocks: DataFrame, keys, bands, weight_cycle: int = 97) -> DataFrame:
    """Cells of each block and per band a sum weighted by place, which tells misplaced readings apart."""
    def checksum(band: str) -> Column:
        weighted = F.transform(band, lambda v, i: v * (i % weight_cycle + 1))
        return F.aggregate(weighted, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0))).alias(f"{band}_sum")

    return blocks.select(*keys, "tile_r", "tile_c", F.size(bands[0]).alias("n_cells"), *map(checksum, bands))
