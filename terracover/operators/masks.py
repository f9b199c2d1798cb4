"""Clear-sky masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracover.operators.joins import large_join, lookup_join
from terracover.operators.morphology import dilate_flags
from terracover.operators.quantiles import histogram_quantiles
from terracover.operators.ranking import GROUP_LIMIT, largest_group
from terracover.sources.staging import stage

SCENE = ("zone", "scene")

# Scene classes and heuristic thresholds.
BAD_CLASSES = (3, 8, 9, 10, 11)
WATER_CLASS = 6
CLEAR_CLASSES = (4, 5, 6)
NDVI_CLOUD = 0.10
NDVI_SHADOW = 0.05
CLOUD_QUANTILE = 0.80
SHADOW_QUANTILE = 0.20


def class_clear(scl: Column, exclude_water: bool = False) -> Column:
    bad = (*BAD_CLASSES, WATER_CLASS) if exclude_water else BAD_CLASSES
    return ~scl.isin(*bad)


def whitelist_clear(scl: Column) -> Column:
    return scl.isin(*CLEAR_CLASSES)


def _cloud(nir: Column, ndvi: Column, bright: Column, limit: float) -> Column:
    return F.coalesce((ndvi < limit) & (nir > bright), F.lit(False))


def scene_thresholds(
    px: DataFrame, keys=SCENE, exclude_water: bool = False, ndvi_cloud: float = NDVI_CLOUD,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Bright and dark NIR thresholds per scene, from a single pass over the pixels.

    Class-clear pixels shrink to counts per NIR value and low-NDVI flag. The bright
    threshold is the 80 % quantile of those counts; the dark one is the 20 % quantile
    of what is left once bright low-NDVI values are removed.
    """
    keys = list(keys)
    counts = stage(
        px.where(class_clear(F.col("scl"), exclude_water))
        .groupBy(*keys, F.col("b8a").alias("nir"), (F.col("ndvi") < ndvi_cloud).alias("low"))
        .agg(F.count(F.lit(1)).alias("n")),
        "nir_counts",
    )
    # Values per scene bound every group below; usually they are few and one plan remains.
    bounded = largest_group(counts, keys) <= limit
    quantile = lambda hist, name, q: histogram_quantiles(
        hist.groupBy(*keys, "nir").agg(F.sum("n").alias("n")),
        keys, "nir", "n", {name: ("linear", q)}, limit, bounded,
    )
    bright = quantile(counts, "bright", CLOUD_QUANTILE)
    left = counts.join(bright, keys).where(~(F.col("low") & (F.col("nir") > F.col("bright"))))
    dark = quantile(left, "dark", SHADOW_QUANTILE)
    return stage(bright.join(dark, keys, "left"), "thresholds")


def clear_before_dilation(
    px: DataFrame, keys=SCENE, exclude_water: bool = False, ndvi_cloud: float = NDVI_CLOUD,
    ndvi_shadow: float = NDVI_SHADOW, limit: int = GROUP_LIMIT, thresholds: DataFrame | None = None,
) -> DataFrame:
    """``px`` with ``clear`` (0/1) after classes, bright-cloud and dark-shadow rules.

    ``thresholds``: those of :func:`scene_thresholds` where they are known, or those of a sketch.
    """
    keys = list(keys)
    if thresholds is None:
        thresholds = scene_thresholds(px, keys, exclude_water, ndvi_cloud, limit)
    nir, ndvi = F.col("b8a"), F.col("ndvi")
    cloudy = _cloud(nir, ndvi, F.col("bright"), ndvi_cloud)
    shady = F.coalesce((ndvi < ndvi_shadow) & (nir < F.col("dark")), F.lit(False))
    clear = class_clear(F.col("scl"), exclude_water) & ~cloudy & ~shady
    return (
        lookup_join(px, thresholds, keys, "left")
        .withColumn("clear", clear.cast("int"))
        .drop("bright", "dark")
    )


def clear_mask(
    px: DataFrame, keys=SCENE, dilate_px: int = 1, exclude_water: bool = False,
    ndvi_cloud: float = NDVI_CLOUD, ndvi_shadow: float = NDVI_SHADOW, limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per scene cell: ``clear`` is 0 for bad cells and their dilated surroundings."""
    flagged = clear_before_dilation(px, keys, exclude_water, ndvi_cloud, ndvi_shadow, limit)
    bad = dilate_flags(
        flagged.withColumn("bad", 1 - F.col("clear")), keys, "bad", max(0, dilate_px)
    )
    return bad.select(*keys, "r", "c", (1 - F.col("bad")).alias("clear"))


def masked_observations(px: DataFrame, mask: DataFrame, keys=SCENE) -> DataFrame:
    """Observations on clear cells."""
    clear = mask.where("clear = 1").drop("clear")
    return large_join(px, clear, [*keys, "r", "c"], "left_semi")


def clear_scenes(mask: DataFrame, cell=("zone", "r", "c"), scene: str = "scene") -> DataFrame:
    """One row per cell with the list of scenes in which it is clear: a mask that lies with the pixels.

    A cell has at most as many entries as its zone has scenes.
    """
    return mask.where("clear = 1").groupBy(*cell).agg(F.sort_array(F.collect_list(scene)).alias("clear_scenes"))


def masked_by_cell(px: DataFrame, scenes: DataFrame, cell=("zone", "r", "c"), scene: str = "scene") -> DataFrame:
    """Observations on clear cells, met by the cell alone, so that stored buckets of cells need no exchange."""
    met = large_join(px, scenes, list(cell))
    return met.where(F.array_contains("clear_scenes", F.col(scene))).select(*px.columns)


def clear_stats(mask: DataFrame, zone: str = "zone", scene: str = "scene") -> DataFrame:
    """Clear and total cells per scene, per zone and overall in one rollup."""
    return (
        mask.rollup(zone, scene)
        .agg(F.sum("clear").alias("n_clear"), F.count(F.lit(1)).alias("n_total"))
        .withColumn("pct_clear", F.col("n_clear") / F.col("n_total") * 100)
    )
