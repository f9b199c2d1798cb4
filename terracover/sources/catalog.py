"""Catalogs derived from object-key listings (one ``path`` per row)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.functions.grid import acquisition_time, tile_epsg
from terracover.functions.spectral import BANDS

# Layer file names a zone must have, and the scene file suffix.
LAYER_FILES = ("Bosque.shp", "Perímetro.shp")
RASTER_SUFFIX = ".tif"

PRODUCT = ("zone", "product")


def product_paths(paths: DataFrame) -> DataFrame:
    """Keys inside a product, with the product's zone folder and name."""
    return paths.where(F.col("path").contains(".SAFE/")).select(
        F.substring_index("path", "/", 1).alias("zone"),
        F.substring_index(F.substring_index("path", ".SAFE/", 1), "/", -1).alias("product"),
        "path",
    )


def product_catalog(paths: DataFrame) -> DataFrame:
    """Distinct products; files of a product combine before the shuffle."""
    return product_paths(paths).select(*PRODUCT).distinct()


def scene_catalog(paths: DataFrame) -> DataFrame:
    """Products with acquisition time and UTM reference system."""
    name = F.col("product")
    return product_catalog(paths).select(
        *PRODUCT, acquisition_time(name).alias("acquired"), tile_epsg(name).alias("epsg")
    )


def band_file_lookup(paths: DataFrame, bands=BANDS, resolution: int = 20) -> DataFrame:
    """First matching file per product and requested band at one resolution."""
    pattern = rf"/R{resolution}m/.*_(B[0-9A-Z]+)_{resolution}m\.jp2"
    wanted = [b.upper() for b in bands]
    return (
        product_paths(paths)
        .withColumn("band", F.regexp_extract("path", pattern, 1))
        .where(F.col("band").isin(wanted))
        .groupBy(*PRODUCT, "band")
        .agg(F.min("path").alias("path"))
    )


def missing_bands(paths: DataFrame, bands=BANDS, resolution: int = 20) -> DataFrame:
    """Requested bands a product lacks, and whether it has none at all.

    One aggregation per product over the fixed band list; nothing is joined.
    """
    wanted = [b.upper() for b in bands]
    pattern = rf"/R{resolution}m/.*_(B[0-9A-Z]+)_{resolution}m\.jp2"
    band = F.regexp_extract("path", pattern, 1)
    requested = F.array(*map(F.lit, wanted))
    found = (
        product_paths(paths)
        .groupBy(*PRODUCT)
        .agg(F.collect_set(F.when(band.isin(wanted), band)).alias("found"))
    )
    return found.select(
        *PRODUCT,
        (F.size("found") == 0).alias("unusable"),
        F.explode(F.array_except(requested, "found")).alias("band"),
    )


def eligible_zones(paths: DataFrame, layers=LAYER_FILES) -> DataFrame:
    """Zones with at least one scene raster and every required layer file."""
    files = paths.select(
        F.substring_index("path", "/", 1).alias("zone"),
        F.substring_index("path", "/", -1).alias("file"),
    )
    has_layer = [F.max(F.col("file") == layer).alias(f"layer_{i}") for i, layer in enumerate(layers)]
    checks = files.groupBy("zone").agg(
        F.count_if(F.col("file").endswith(RASTER_SUFFIX)).alias("n_rasters"), *has_layer
    )
    complete = F.col("n_rasters") > 0
    for i in range(len(layers)):
        complete = complete & F.col(f"layer_{i}")
    return checks.where(complete).select("zone", "n_rasters")
