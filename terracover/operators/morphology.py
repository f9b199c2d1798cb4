"""Dilation, erosion and L1 distances of cell sets.

The structuring element is the cross repeated ``radius`` times, i.e. the L1 ball. The L1
distance is separable: it is found along the rows first, then along the columns with the
first result as a head start. Each pass sorts the cells of one line and looks at running
minima, so its work does not depend on the radius. Lines are cut into tiles that also see
the cells within reach beyond their borders, so a group is a tile's line, however large the
grid. For small radii neighbours are counted instead, which takes one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Radii up to this one count neighbours: at most 13 rows a cell.
NEAR = 2
# Least number of cells along a tile's line, as a power of two.
TILE_BITS = 8


def ball(radius: int) -> list[tuple[int, int]]:
    """Offsets within L1 distance ``radius``."""
    span = range(-radius, radius + 1)
    return [(dr, dc) for dr in span for dc in span if abs(dr) + abs(dc) <= radius]


def _steps(offsets):
    return F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in offsets))


def _spread(cells: DataFrame, keys, steps) -> DataFrame:
    return cells.select(*keys, "r", "c", F.explode(steps).alias("o")).select(
        *keys, (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c")
    )


def _bits(reach: int) -> int:
    """Tiles of at least twice the reach, so a cell is seen by two of them at most."""
    return max(TILE_BITS, (2 * reach).bit_length())


def _in_tiles(cells: DataFrame, axis: str, reach: int) -> tuple[DataFrame, Column]:
    """A row per tile within reach of each cell along ``axis``; and whether it is the cell's own."""
    bits = _bits(reach)
    near = F.array_distinct(F.array(*(F.shiftright(F.col(axis) + d, bits) for d in (-reach, 0, reach))))
    return cells.withColumn("tile", F.explode(near)), F.col("tile") == F.shiftright(axis, bits)


def _reach_along(cells: DataFrame, line, axis: str, radius: int) -> DataFrame:
    """Cells of each line within ``radius`` of a given one, that one's ``distance`` added.

    A cell whose distance another one reaches by stepping along the line adds nothing. Of the
    rest, neighbours divide the stretch between them, so every cell of the result comes once.
    """
    bits = _bits(radius)
    tiled, _ = _in_tiles(cells, axis, radius)
    order = Window.partitionBy(*line, "tile").orderBy(axis, "distance")
    at, d = F.col(axis), F.col("distance")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    reached = (F.coalesce(F.min(d - at).over(before) + at <= d, F.lit(False))
               | F.coalesce(F.min(d + at).over(after) - at < d, F.lit(False)))
    # The winner of a tie at the same place is the first, at different places the lower one.
    kept = tiled.withColumn("reached", reached).where(~F.col("reached")).drop("reached")
    lag = F.lag(F.struct(axis, "distance")).over(order)
    lead = F.lead(F.struct(axis, "distance")).over(order)
    bounded = kept.withColumns({"prior": lag, "next": lead})
    middle = lambda low, low_d, high, high_d: F.shiftright(high_d - low_d + high + low, 1)
    first = F.greatest(
        at - (radius - d), F.shiftleft("tile", bits),
        F.when(F.col("prior").isNotNull(), middle(F.col("prior")[axis], F.col("prior")["distance"], at, d) + 1),
    )
    last = F.least(
        at + (radius - d), F.shiftleft("tile", bits) + (1 << bits) - 1,
        F.when(F.col("next").isNotNull(), middle(at, d, F.col("next")[axis], F.col("next")["distance"])),
    )
    spans = bounded.withColumns({"first": first, "last": last}).where("first <= last")
    return spans.withColumn("to", F.explode(F.sequence("first", "last"))).select(
        *line, F.col("to").alias(axis), (d + F.abs(F.col("to") - at)).alias("distance")
    )


def l1_reach(cells: DataFrame, keys, radius: int) -> DataFrame:
    """Cells within ``radius`` of a given cell with their ``distance``, on an unbounded grid."""
    keys = list(keys)
    whole = cells.select(*keys, F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.lit(0).alias("distance"))
    along_rows = _reach_along(whole, [*keys, "r"], "c", radius)
    return _reach_along(along_rows, [*keys, "c"], "r", radius).select(*keys, "r", "c", "distance")


def _depth_along(cells: DataFrame, line, axis: str, limit: int, start: Column | None) -> DataFrame:
    """Distance to the next cell that is missing along a line or from ``start`` there, at most ``limit``."""
    tiled, own = _in_tiles(cells, axis, limit)
    order = Window.partitionBy(*line, "tile").orderBy(axis)
    at = F.col(axis)
    back, ahead = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    begins = F.coalesce(F.lag(axis).over(order) < at - 1, F.lit(True))
    ends = F.coalesce(F.lead(axis).over(order) > at + 1, F.lit(True))
    marked = tiled.withColumns({"begins": F.when(begins, at), "ends": F.when(ends, at)})
    ways = [F.lit(limit), at - F.max("begins").over(back) + 1, F.min("ends").over(ahead) - at + 1]
    if start is not None:
        # Cells behind a gap cost more than the gap itself, so runs need not be told apart.
        ways += [F.min(start - at).over(back) + at, F.min(start + at).over(ahead) - at]
    return marked.withColumn("depth", F.least(*ways)).where(own).drop("tile", "begins", "ends")


def l1_depth(cells: DataFrame, keys, limit: int) -> DataFrame:
    """Distance of every cell to the nearest one outside the set, at most ``limit``.

    ``cells`` must be distinct. What lies beyond a grid is outside.
    """
    keys = list(keys)
    whole = cells.select(*keys, F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"))
    along_rows = _depth_along(whole, [*keys, "r"], "c", limit, None)
    return _depth_along(along_rows, [*keys, "c"], "r", limit, F.col("depth")).select(*keys, "r", "c", "depth")


def dilate_flags(cells: DataFrame, keys, flag: str, radius: int = 1) -> DataFrame:
    """One row per distinct cell of ``cells``; ``flag`` is 1 within reach of a flagged cell.

    ``cells`` may hold several rows per cell; cells outside it are not created. Flagged
    cells emit their neighbourhood and others only themselves, in one pass; beyond small
    radii the cells within reach come from the distances.
    """
    keys = list(keys)
    flagged = F.col(flag) == 1
    if radius > NEAR:
        near = l1_reach(cells.where(flagged), keys, radius).select(*keys, "r", "c", F.lit(1).alias(flag), F.lit(False).alias("home"))
        moved = cells.select(*keys, "r", "c", F.col(flag).cast("int").alias(flag), F.lit(True).alias("home")).unionByName(near)
        return moved.groupBy(*keys, "r", "c").agg(F.max("home").alias("home"), F.max(flag).alias(flag)).where("home").drop("home")
    steps = F.when(flagged, _steps(ball(radius))).otherwise(_steps([(0, 0)]))
    plain = cells.select(*keys, "r", "c", flag).withColumn("steps", steps)
    moved = plain.select(*keys, "r", "c", flag, F.explode("steps").alias("o"))
    return (
        moved.groupBy(*keys, (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"))
        .agg(
            F.max((F.col("o.dr") == 0) & (F.col("o.dc") == 0)).alias("home"),
            F.max(F.col(flag).cast("int")).alias(flag),
        )
        .where("home")
        .drop("home")
    )


def dilate(cells: DataFrame, keys, radius: int = 1) -> DataFrame:
    """All cells within ``radius`` of a given cell, on an unbounded grid."""
    keys = list(keys)
    if radius > NEAR:
        return l1_reach(cells, keys, radius).drop("distance")
    return _spread(cells, keys, _steps(ball(radius))).distinct()


def erode(cells: DataFrame, keys, radius: int = 1) -> DataFrame:
    """Cells whose whole neighbourhood is in ``cells``; ``cells`` must be distinct."""
    keys = list(keys)
    reach = ball(radius)
    if len(reach) == 1:
        return cells.select(*keys, "r", "c")
    if radius > NEAR:
        return l1_depth(cells, keys, radius + 1).where(F.col("depth") > radius).drop("depth")
    return (
        _spread(cells, keys, _steps(reach))
        .groupBy(*keys, "r", "c")
        .agg(F.count(F.lit(1)).alias("votes"))
        .where(F.col("votes") == len(reach))
        .select(*keys, "r", "c")
    )
