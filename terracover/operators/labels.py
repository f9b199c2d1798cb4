"""Label grids: 1 forest, 0 non-forest, -1 ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.functions.grades import label_balance
from terracover.operators.morphology import erode
from terracover.operators.polygons import grid_cells, polygon_cells

CELL = ("zone", "r", "c")


def label_grid(
    edges: DataFrame, extent: DataFrame, erosion_px: int = 1, use_perimeter: bool = True
) -> DataFrame:
    """Label of every grid cell; forest is eroded, cells outside the perimeter ignored.

    Without a perimeter every grid cell is labelled 0 or 1. Grid, perimeter and forest
    rows meet in one aggregation on the cell key.
    """
    layers = ["forest", "perimeter"] if use_perimeter else ["forest"]
    cells = polygon_cells(edges.where(F.col("layer").isin(layers)), extent)
    forest = erode(cells.where("layer = 'forest'").select(*CELL), ["zone"], max(0, erosion_px))
    flags = lambda df, grid, perimeter, wood: df.select(
        *CELL,
        F.lit(grid).alias("in_grid"), F.lit(perimeter).alias("in_perimeter"), F.lit(wood).alias("in_forest"),
    )
    parts = flags(grid_cells(extent), 1, 0 if use_perimeter else 1, 0).unionByName(flags(forest, 0, 0, 1))
    if use_perimeter:
        parts = parts.unionByName(flags(cells.where("layer = 'perimeter'"), 0, 1, 0))
    return (
        parts.groupBy(*CELL)
        .agg(*(F.max(f).alias(f) for f in ("in_grid", "in_perimeter", "in_forest")))
        .where("in_grid = 1")
        .select(
            *CELL,
            F.when(F.col("in_perimeter") == 0, -1)
            .otherwise(F.col("in_forest"))
            .cast("smallint")
            .alias("label"),
        )
    )


def label_counts(labels: DataFrame, *keys: str) -> DataFrame:
    """Rows per label with percentages and the non-forest to forest ratio."""
    count = lambda value: F.count_if(F.col("label") == value)
    total = F.col("n_total")
    return (
        labels.groupBy(*keys)
        .agg(
            count(1).alias("n_forest"), count(0).alias("n_nonforest"), count(-1).alias("n_ignored"),
            F.count(F.lit(1)).alias("n_total"),
        )
        .withColumns(
            {f"pct_{name}": F.col(f"n_{name}") / total * 100 for name in ("forest", "nonforest", "ignored")}
        )
        .withColumn("ratio", F.when(F.col("n_forest") > 0, F.col("n_nonforest") / F.col("n_forest")))
        .withColumn("balance", label_balance(F.col("n_forest"), F.col("n_nonforest")))
    )


def erosion_stats(cells: DataFrame, radius: int = 1) -> DataFrame:
    """Forest cells before and after erosion per zone and the share removed."""
    forest = cells.where("layer = 'forest'").select(*CELL)
    marked = forest.withColumn("kept", F.lit(0)).unionByName(
        erode(forest, ["zone"], radius).withColumn("kept", F.lit(1))
    )
    return (
        marked.groupBy("zone")
        .agg(F.count_if(F.col("kept") == 0).alias("n_before"), F.count_if(F.col("kept") == 1).alias("n_after"))
        .withColumn("n_removed", F.col("n_before") - F.col("n_after"))
        .withColumn("pct_removed", F.col("n_removed") / F.col("n_before") * 100)
    )
