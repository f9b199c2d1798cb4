"""Registry of runnable queries over the driver tables.

Every callable takes ``(spark, sf_dir)``. Doubles are rounded on output so that two
engines summing in different orders agree.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracover.functions.grid import acquisition_time, bounds_check, clamp_index, grid_index, pixel_center, tile_epsg
from terracover.functions.spectral import BANDS, scale_bands, with_indices
from terracover.operators import dataset, metrics, models, neighbours, placement, quality, regrid, rings, sketches, splits, tiles, weights
from terracover.operators.composite import (
    FEATURES, composite_stats, index_quantiles, min_support, observation_profile, requested_stats, support_profile,
    temporal_composite, valid_observations, with_window_start,
)
from terracover.operators.joins import lookup_join
from terracover.operators.labels import erosion_stats, label_counts, label_grid
from terracover.operators.masks import (
    class_clear, clear_before_dilation, clear_mask, clear_scenes, clear_stats, masked_observations, scene_thresholds, whitelist_clear,
)
from terracover.operators.morphology import dilate, erode, l1_depth, l1_reach
from terracover.operators.polygons import clip_outcome, clip_reduction, clip_to_layer, polygon_cells, polygon_edges
from terracover.operators.report import evaluation_report
from terracover.plans import jobs, zones
from terracover.sources import catalog, landscape as land, sinks, store
from terracover.sources.readers import raster_to_pixels, read_union, read_zones, zone_status
from terracover.sources.session import tune
from terracover.sources.staging import stage, staging_path

CELL = land.CELL
Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return run


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(
        *(
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f.name
            for f in df.schema
        )
    )


# shared inputs ---------------------------------------------------------------------

def _px(spark, sf_dir):
    return land.reflectances(spark, sf_dir)


def _obs(spark, sf_dir):
    return valid_observations(_px(spark, sf_dir))


def _edges(spark, sf_dir, extent=None):
    return polygon_edges(land.vertices(spark, sf_dir, extent))


def _extent(spark, sf_dir):
    """Grid extents as a stored table, computed once per query."""
    return stage(land.zone_extent(spark, sf_dir), "extent")


def _transforms(spark, sf_dir):
    return stage(land.scene_transforms(spark, sf_dir), "transforms")


def _polygon_cells(spark, sf_dir):
    extent = _extent(spark, sf_dir)
    return polygon_cells(_edges(spark, sf_dir, extent), extent)


def _labels(spark, sf_dir, extent=None):
    extent = _extent(spark, sf_dir) if extent is None else extent
    return label_grid(_edges(spark, sf_dir, extent), extent)


def _training(spark, sf_dir):
    composite = temporal_composite(_obs(spark, sf_dir))
    return dataset.join_labels(composite, _labels(spark, sf_dir))


def _class_rows(spark, sf_dir):
    """Labels of occupied pixels without the composite behind them."""
    pixels = _obs(spark, sf_dir).select(*CELL).distinct()
    return dataset.join_labels(pixels, _labels(spark, sf_dir), exclude_ignored=False)


# sources and catalog ---------------------------------------------------------------

@query
def product_catalog(spark, sf_dir):
    return catalog.product_catalog(land.product_paths(spark, sf_dir)).orderBy("zone", "product")


@query
def scene_catalog(spark, sf_dir):
    return catalog.scene_catalog(land.product_paths(spark, sf_dir)).orderBy("zone", "product")


@query
def band_file_lookup(spark, sf_dir):
    return catalog.band_file_lookup(land.product_paths(spark, sf_dir))


@query
def missing_bands(spark, sf_dir):
    return catalog.missing_bands(land.product_paths(spark, sf_dir))


@query
def eligible_zones(spark, sf_dir):
    return catalog.eligible_zones(land.asset_paths(spark, sf_dir)).orderBy("zone")


@query
def tile_crs(spark, sf_dir):
    products = catalog.product_catalog(land.product_paths(spark, sf_dir))
    return products.groupBy("zone", tile_epsg(F.col("product")).alias("epsg")).agg(
        F.count(F.lit(1)).alias("n_products"),
        F.min(acquisition_time(F.col("product"))).alias("first_acquired"),
    )


@query
def raster_to_pixels_query(spark, sf_dir):
    pixels = raster_to_pixels(land.raster_blocks(spark, sf_dir), ["block"], ["band_1", "band_2"], width=8)
    return pixels.withColumns({b: F.col(b).cast("double") for b in ("band_1", "band_2")})


@query
def read_union_by_name(spark, sf_dir):
    both = read_union(spark, f"{sf_dir}/labels.parquet, {sf_dir}/documents.parquet")
    return both.select("doc_id", "quality", "toxic", "text", "lang", "source", "n_chars")


@query
def polygon_edges_query(spark, sf_dir):
    return rounded(_edges(spark, sf_dir))


# scalar operators ------------------------------------------------------------------

@query
def scale_reflectance(spark, sf_dir):
    scaled = scale_bands(land.scene_pixels(spark, sf_dir))
    return rounded(
        scaled.groupBy("zone", "scene").agg(
            *(fn(b).alias(f"{b}_{n}") for b in BANDS for n, fn in (("min", F.min), ("max", F.max))),
            *(F.sum(b).alias(f"{b}_sum") for b in BANDS),
        ), 6,
    )


@query
def spectral_indices(spark, sf_dir):
    return rounded(_px(spark, sf_dir).select(*CELL, "ts", "b03", "b04", "b8a", "ndvi", "ndwi"))


@query
def spectral_indices_ext(spark, sf_dir):
    """NDBI, NDMI, EVI and SAVI on composite medians."""
    medians = temporal_composite(_obs(spark, sf_dir), bands=("b02", "b04", "b8a", "b11"))
    plain = medians.withColumnsRenamed({f"{b}_med": b for b in ("b02", "b04", "b8a", "b11")})
    return rounded(with_indices(plain, ("ndbi", "ndmi", "evi", "savi")).select(*CELL, "ndbi", "ndmi", "evi", "savi"))


@query
def pixel_centers(spark, sf_dir):
    px = lookup_join(_px(spark, sf_dir).select(*CELL, "ts"), _transforms(spark, sf_dir), "zone")
    return rounded(
        px.select(
            *CELL, "ts",
            pixel_center(F.col("x0"), F.col("a"), F.col("c")).alias("x"),
            pixel_center(F.col("y0"), F.col("e"), F.col("r")).alias("y"),
        )
    )


@query
def grid_address(spark, sf_dir):
    """Displaced pixel positions looked up on the grid, some of them beyond its border."""
    shift = F.expr("CAST((r + c) % 7 - 3 AS DOUBLE)")
    px = lookup_join(_px(spark, sf_dir).select(*CELL, "ts"), _transforms(spark, sf_dir), "zone")
    at = px.withColumns({
        "x": F.col("x0") + F.col("a") * (F.col("c") + shift + 0.25),
        "y": F.col("y0") + F.col("e") * (F.col("r") + shift + 0.25),
    })
    col, row = grid_index(F.col("x0"), F.col("a"), F.col("x")), grid_index(F.col("y0"), F.col("e"), F.col("y"))
    return at.select(
        *CELL, "ts",
        clamp_index(row, F.col("height")).alias("row_idx"),
        clamp_index(col, F.col("width")).alias("col_idx"),
    )


@query
def bounds_check_query(spark, sf_dir):
    corner = lambda origin, step, n: F.col(origin) + F.col(step) * F.col(n)
    zones = land.scene_transforms(spark, sf_dir)
    checked = zones.withColumn(
        "b", bounds_check(F.col("x0"), corner("y0", "e", "height"), corner("x0", "a", "width"), F.col("y0"))
    )
    return checked.select("zone", "b.lat_valid", "b.lon_valid", "b.valid")


@query
def clean_features(spark, sf_dir):
    """Odd values set to 0, next to the rows that assembly would keep."""
    raw = _px(spark, sf_dir).select(
        *CELL, "ts",
        F.when(F.col("b03") == 0, F.lit(float("nan"))).otherwise(F.col("b03")).alias("f1"),
        F.when(F.col("b04") == 1, F.lit(float("inf"))).otherwise(F.col("b04")).alias("f2"),
        F.when(F.col("b8a") == 0, F.lit(None)).otherwise(F.col("b8a")).alias("f3"),
    )
    kept = dataset.complete_rows(raw, ["f1", "f3"]).groupBy("zone").agg(F.count(F.lit(1)).alias("n_kept"))
    cleaned = dataset.clean_features(raw, ["f1", "f2", "f3"]).groupBy("zone").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(f"{c}_sum") for c in ("f1", "f2", "f3"))
    )
    return rounded(cleaned.join(kept, "zone"), 6)


@query
def stack_bands(spark, sf_dir):
    """Long band rows of each scene cell stacked to one row per cell."""
    keys = ["zone", "scene", "r", "c"]
    wide = list(FEATURES)
    long = _px(spark, sf_dir).unpivot(keys, wide, "band", "value")
    return rounded(regrid.stack_bands(long, keys, wide))


@query
def regrid_bilinear(spark, sf_dir):
    targets = regrid.scaled_targets(_extent(spark, sf_dir), 3, 4)
    return rounded(regrid.bilinear(targets, land.cell_maxima(spark, sf_dir), ["zone"], list(FEATURES)), 12)


@query
def reproject_bilinear(spark, sf_dir):
    """UTM scenes resampled to geographic grids."""
    grids = regrid.geographic_grid(land.utm_scenes(spark, sf_dir), ["zone"])
    targets = regrid.reprojected_targets(grids, ["zone"])
    return rounded(regrid.bilinear(targets, land.cell_maxima(spark, sf_dir), ["zone"], list(FEATURES)), 4)


@query
def regrid_nearest(spark, sf_dir):
    """Scene classes carried to a coarser grid without mixing them."""
    classes = _px(spark, sf_dir).groupBy(*CELL).agg(F.max("scl").alias("scl"))
    targets = regrid.scaled_targets(_extent(spark, sf_dir), 3, 4)
    return regrid.nearest(targets, classes, ["zone"], ["scl"])


# filters and masks -----------------------------------------------------------------

@query
def valid_observations_query(spark, sf_dir):
    return rounded(_obs(spark, sf_dir).select(*CELL, "ts", *BANDS))


@query
def clear_mask_query(spark, sf_dir):
    return clear_mask(_px(spark, sf_dir))


@query
def clear_mask_no_water(spark, sf_dir):
    return clear_mask(_px(spark, sf_dir), exclude_water=True)


@query
def clear_thresholds(spark, sf_dir):
    """Bright and dark thresholds and clear looks per scene before dilation."""
    px = _px(spark, sf_dir)
    known = scene_thresholds(px)
    looks = clear_before_dilation(px, thresholds=known).groupBy("zone", "scene").agg(
        F.sum("clear").alias("n_clear"), F.count(F.lit(1)).alias("n_total")
    )
    limits = known.select("zone", "scene", F.col("bright").alias("p80"), F.col("dark").alias("p20"))
    return rounded(looks.join(limits, ["zone", "scene"], "left"))


@query
def sketched_thresholds(spark, sf_dir):
    """Thresholds from sketches of two halves of each scene, merged: are their exact ranks within the bound?"""
    keys = ["zone", "scene"]
    px = _px(spark, sf_dir).select("zone", "scene", "c", "scl", "b8a", "ndvi")
    halves = [stage(sketches.scene_sketches(px.where(F.col("c") % 2 == half)), "sketch") for half in (0, 1)]
    merged = stage(sketches.merge(halves, [*keys, "low"]), "sketch")
    limits = stage(sketches.sketched_thresholds(merged), "limits")
    clear = lookup_join(px.where(class_clear(F.col("scl"))), limits, keys)
    code, left = sketches.code_of(F.col("b8a")), ~((F.col("ndvi") < 0.1) & (F.col("b8a") > F.col("bright")))
    top = lambda c: F.round(F.col(c) * sketches.TOP).cast("int")
    # Shares below and up to a threshold enclose the rank it was asked for.
    ranks = clear.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_clear"), F.count_if(code < top("bright")).alias("b0"), F.count_if(code <= top("bright")).alias("b1"),
        F.count_if(left).alias("n_left"), F.count_if(left & (code < top("dark"))).alias("d0"), F.count_if(left & (code <= top("dark"))).alias("d1"),
    )
    near = lambda low, high, n, q, off: (F.col(low) <= q * F.col(n) + off) & (F.col(high) >= q * F.col(n) - off)
    off = 2 * sketches.rank_bound(sketches.K) * F.col("n_clear") + 1
    return ranks.select(*keys, "n_clear", near("b0", "b1", "n_clear", 0.8, off).alias("bright_within"), near("d0", "d1", "n_left", 0.2, off).alias("dark_within"))


@query
def clear_whitelist(spark, sf_dir):
    return _px(spark, sf_dir).where(whitelist_clear(F.col("scl"))).select(*CELL, "ts", "scl")


@query
def dilate_mask(spark, sf_dir):
    """Cloud-class cells of each scene grown by two pixels."""
    clouds = _px(spark, sf_dir).where(F.col("scl").isin(8, 9)).select("zone", "scene", "r", "c").distinct()
    return dilate(clouds, ["zone", "scene"], 2)


@query
def erode_mask(spark, sf_dir):
    cells = _polygon_cells(spark, sf_dir)
    return erode(cells.where("layer = 'forest'").select(*CELL), ["zone"], 2)


@query
def dilate_far(spark, sf_dir):
    """Cells within 12 of a cloud-class cell of their scene, with the distance."""
    clouds = _px(spark, sf_dir).where(F.col("scl").isin(8, 9)).select("zone", "scene", "r", "c").distinct()
    return l1_reach(clouds, ["zone", "scene"], 12)


@query
def erode_far(spark, sf_dir):
    cells = _polygon_cells(spark, sf_dir)
    return erode(cells.where("layer = 'forest'").select(*CELL), ["zone"], 7)


@query
def forest_depth(spark, sf_dir):
    """Distance of every forest cell to the forest's edge, up to 15 cells."""
    cells = _polygon_cells(spark, sf_dir)
    return l1_depth(cells.where("layer = 'forest'").select(*CELL), ["zone"], 15)


@query
def clear_stats_query(spark, sf_dir):
    return rounded(clear_stats(clear_mask(_px(spark, sf_dir))))


@query
def masked_composite(spark, sf_dir):
    px = _px(spark, sf_dir)
    clear = masked_observations(px, clear_mask(px))
    return rounded(temporal_composite(valid_observations(clear), at_most=px))


@query
def min_support_query(spark, sf_dir):
    composite = _obs(spark, sf_dir).groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_obs"))
    return min_support(composite, 3, 100)


@query
def enough_per_class(spark, sf_dir):
    return dataset.enough_per_class(land.class_labels(spark, sf_dir), 100)


@query
def zone_subset(spark, sf_dir):
    rows = dataset.zone_subset(_px(spark, sf_dir), include=[0, 1, 2, 3], exclude=[2])
    return rows.groupBy("zone").agg(F.count(F.lit(1)).alias("n"))


@query
def clip_perimeter(spark, sf_dir):
    px = _px(spark, sf_dir).select(*CELL, "ts", *FEATURES)
    extent = _extent(spark, sf_dir)
    return rounded(clip_to_layer(px, _edges(spark, sf_dir, extent), extent))


def _chosen_parcels(spark, sf_dir):
    """Placed forest parcels of two owners, and their grids."""
    vertices, grids = _placed(spark, sf_dir)
    return placement.place_edges(vertices.where("layer = 'forest' AND poly_id % 10 IN (2, 7)"), grids), grids.select("zone", "height", "width")


@query
def clip_pruned(spark, sf_dir):
    """Looks inside a few parcels, read from sorted files within the parcels' bounds."""
    path = staging_path(spark, "sorted")
    store.write_sorted(_px(spark, sf_dir).select(*CELL, "ts", *FEATURES), path)
    edges, extent = _chosen_parcels(spark, sf_dir)
    return rounded(jobs.clip_stored(spark, path, edges, extent, "forest"))


@query
def clip_outcome_query(spark, sf_dir):
    """Looks of one day and zone as a scene; days without a look in the forest layer stay whole."""
    px = _px(spark, sf_dir).select(*CELL, "ts", F.to_date("ts").alias("day"), "ndvi")
    extent = _extent(spark, sf_dir)
    return rounded(clip_outcome(px, _edges(spark, sf_dir, extent), extent, ["zone", "day"], "forest"))


@query
def clip_reduction_query(spark, sf_dir):
    px = _px(spark, sf_dir).select(*CELL)
    extent = _extent(spark, sf_dir)
    clipped = clip_to_layer(px, _edges(spark, sf_dir, extent), extent)
    return rounded(clip_reduction(px, clipped))


# stored pixels ---------------------------------------------------------------------

@query
def training_table_stored(spark, sf_dir):
    """Training rows from bucketed observations and labels."""
    obs = stage(_obs(spark, sf_dir).select(*CELL, *FEATURES), "obs")
    buckets = store.bucket_count(obs.count())
    labels = store.store_buckets(_labels(spark, sf_dir), buckets, name="labels")
    return rounded(jobs.stored_training(store.store_buckets(obs, buckets, name="obs"), labels))


@query
def masked_composite_stored(spark, sf_dir):
    """Masked composite from bucketed pixels and clear scenes."""
    px = stage(_px(spark, sf_dir).select(*CELL, "scene", "scl", *FEATURES), "px")
    buckets = store.bucket_count(px.count())
    scenes = store.store_buckets(clear_scenes(clear_mask(px)), buckets, name="clear")
    return rounded(jobs.stored_masked_composite(store.store_buckets(px, buckets, name="px"), scenes))


_SCENE_BANDS = list(FEATURES)


@query
def scene_blocks(spark, sf_dir):
    """256 x 256 blocks of the highest readings, by sums that depend on the places."""
    blocks = tiles.pixels_to_blocks(land.cell_maxima(spark, sf_dir), ["zone"], _SCENE_BANDS)
    return rounded(tiles.block_sums(blocks, ["zone"], _SCENE_BANDS), 4)


@query
def scene_blocks_read(spark, sf_dir):
    """Blocks written as a scene table, read back as pixels."""
    path = staging_path(spark, "blocks")
    sinks.write_blocks(land.cell_maxima(spark, sf_dir), path, ["zone"], _SCENE_BANDS, size=64)
    return rounded(tiles.blocks_to_pixels(spark.read.parquet(path), ["zone"], _SCENE_BANDS, size=64))


@query
def zone_run_committed(spark, sf_dir):
    """A run of all expected zones, stopped after its first step and taken up again."""
    run, extent = zones.ZoneRun(spark, staging_path(spark, "run")), _extent(spark, sf_dir)
    px = _px(spark, sf_dir).select(*CELL, "b02", "ndvi")
    steps = jobs.zone_steps(run, px, stage(_edges(spark, sf_dir, extent), "edges"), extent)
    expected = land.run_log(spark, sf_dir).select("zone")
    run.run(expected, {"03_features": steps["03_features"]})
    return run.run(expected, steps).drop("message")


# composites ------------------------------------------------------------------------

@query
def temporal_composite_query(spark, sf_dir):
    return rounded(temporal_composite(_obs(spark, sf_dir)))


@query
def ndvi_quantiles(spark, sf_dir):
    return rounded(index_quantiles(_obs(spark, sf_dir)))


@query
def composite_stats_query(spark, sf_dir):
    # Means of short decimals tie at few digits; deviations carry more noise.
    stats = composite_stats(_obs(spark, sf_dir), bands=FEATURES)
    return rounded(stats.withColumns({f"{b}_std": F.round(f"{b}_std", 8) for b in FEATURES}), 12)


@query
def composite_requested(spark, sf_dir):
    """Statistics asked for band by band."""
    request = {
        "b04": ("median", "p25", "p75"), "b8a": ("mean", "std", "min", "max", "median"),
        "ndvi": ("median", "mean", "std", "min", "max", "p25", "p75"), "ndwi": ("p10",),
    }
    stats = requested_stats(_obs(spark, sf_dir), request)
    return rounded(stats.withColumns({f"{b}_std": F.round(f"{b}_std", 8) for b in ("b8a", "ndvi")}), 12)


@query
def composite_30d(spark, sf_dir):
    """Zone composites per 30-day window."""
    obs = with_window_start(_obs(spark, sf_dir))
    return rounded(temporal_composite(obs, ["zone", "window_start"]))


@query
def composite_annual(spark, sf_dir):
    obs = _obs(spark, sf_dir).withColumn("year", F.year("ts"))
    return rounded(temporal_composite(obs, [*CELL, "year"]))


@query
def observation_profile_query(spark, sf_dir):
    return observation_profile(_obs(spark, sf_dir))


@query
def support_profile_query(spark, sf_dir):
    per_pixel = _obs(spark, sf_dir).groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_obs"))
    return rounded(support_profile(per_pixel), 6)


# labels and training tables --------------------------------------------------------

@query
def rasterize_polygons(spark, sf_dir):
    return _polygon_cells(spark, sf_dir)


def _placed(spark, sf_dir):
    """Georeferenced rings and the grids they are placed on."""
    grids = stage(land.scene_grids(spark, sf_dir), "grids")
    return land.georeferenced_rings(spark, sf_dir, grids), grids


@query
def place_edges(spark, sf_dir):
    """Rings in degrees and metres as edges in cell units."""
    edges = placement.place_edges(*_placed(spark, sf_dir))
    return rounded(edges.groupBy("zone", "layer", "poly_id", "ring").agg(
        F.count(F.lit(1)).alias("n_edges"), *(F.min(c).alias(f"{c}_min") for c in ("x1", "y1")), *(F.max(c).alias(f"{c}_max") for c in ("x2", "y2")),
        F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).alias("area2"),
    ), 5)


@query
def place_layers(spark, sf_dir):
    """Cells of georeferenced layers, holes left out."""
    return placement.place_layers(*_placed(spark, sf_dir))


@query
def label_grid_placed(spark, sf_dir):
    """Label grid from georeferenced layers."""
    vertices, grids = _placed(spark, sf_dir)
    return label_grid(placement.place_edges(vertices, grids), grids.select("zone", "height", "width"))


@query
def dissolved_rings(spark, sf_dir):
    """Outlines of the dissolved layers, summed per zone and layer."""
    cells = _polygon_cells(spark, sf_dir)
    return rings.ring_measures(rings.dissolved_rings(cells)).groupBy("zone", "layer").agg(
        (F.count_if(F.col("area") > 0) - F.count_if(F.col("area") < 0)).alias("outer_less_holes"),
        *(F.sum(c).alias(c) for c in ("n_corners", "perimeter", "area")),
    )


@query
def dissolve_round_trip(spark, sf_dir):
    """Cells of georeferenced layers, traced to rings and filled again."""
    vertices, grids = _placed(spark, sf_dir)
    traced = rings.dissolved_rings(placement.place_layers(vertices, grids))
    return polygon_cells(rings.ring_edges(traced), grids.select("zone", "height", "width"))


@query
def label_grid_query(spark, sf_dir):
    return _labels(spark, sf_dir)


@query
def label_grid_open(spark, sf_dir):
    """Label grid without a perimeter."""
    extent = _extent(spark, sf_dir)
    return label_grid(_edges(spark, sf_dir, extent), extent, 1, use_perimeter=False)


@query
def label_stats(spark, sf_dir):
    return rounded(label_counts(_labels(spark, sf_dir), "zone"))


@query
def erosion_stats_query(spark, sf_dir):
    return rounded(erosion_stats(_polygon_cells(spark, sf_dir)))


@query
def training_table(spark, sf_dir):
    return rounded(_training(spark, sf_dir))


@query
def training_clamped(spark, sf_dir):
    """Pixels moved off the grid take the label of the nearest border cell."""
    moved = (
        _obs(spark, sf_dir).select(*CELL).distinct()
        .withColumns({"r": F.col("r") + F.expr("c % 3 - 1"), "c": F.col("c") + 2})
    )
    extent = _extent(spark, sf_dir)
    return dataset.join_labels(
        moved, _labels(spark, sf_dir, extent), extent, mode="clamp", exclude_ignored=False
    )


@query
def label_distribution(spark, sf_dir):
    return rounded(dataset.label_distribution(_class_rows(spark, sf_dir)))


@query
def class_balance(spark, sf_dir):
    return rounded(dataset.class_balance(_class_rows(spark, sf_dir).where("label <> -1"), "zone"))


@query
def consolidate_zones(spark, sf_dir):
    """Training rows written by zone, read back as one partitioned table."""
    path = staging_path(spark, "zones")
    sinks.write_zones(_training(spark, sf_dir), path)
    return rounded(read_zones(spark, path))


@query
def zone_status_query(spark, sf_dir):
    """Training labels written by zone, and what can be read of each zone."""
    path = staging_path(spark, "zones")
    sinks.write_zones(_class_rows(spark, sf_dir), path)
    return zone_status(spark, path).select("zone", "n_unreadable", "n_rows", "status")


@query
def zone_stats(spark, sf_dir):
    return rounded(dataset.zone_stats(_class_rows(spark, sf_dir).where("label <> -1")))


@query
def dataset_checks(spark, sf_dir):
    rows = splits.hash_split(_training(spark, sf_dir), CELL)
    return dataset.dataset_checks(rows, dataset.feature_columns(rows))


@query
def empty_zones(spark, sf_dir):
    expected = land.run_log(spark, sf_dir).select("zone")
    return dataset.empty_zones(expected, _class_rows(spark, sf_dir).where("label <> -1"))


# quality ---------------------------------------------------------------------------

@query
def quarantine(spark, sf_dir):
    return quality.quarantine(land.product_meta(spark, sf_dir))


@query
def clean_products(spark, sf_dir):
    return quality.clean_products(land.product_meta(spark, sf_dir)).select("zone", "product", "file_crs")


@query
def clean_products_tolerant(spark, sf_dir):
    kept = quality.clean_products(land.product_meta(spark, sf_dir), keep_if=["crs_mismatch"])
    return kept.select("zone", "product", "file_crs")


@query
def quarantine_summary(spark, sf_dir):
    return quality.quarantine_summary(quality.quarantine(land.product_meta(spark, sf_dir)))


@query
def zone_run(spark, sf_dir):
    """Rows of every expected zone after features, labels and their union; zones without rows fail."""
    pixels = _obs(spark, sf_dir).select(*CELL).distinct()
    labels = stage(_labels(spark, sf_dir).where("label <> -1"), "labels")
    union = pixels.join(labels, list(CELL))
    expected = land.run_log(spark, sf_dir)
    return quality.zone_run(expected, {"03_features": pixels, "04_labels": labels, "05_union": union})


@query
def run_report(spark, sf_dir):
    return rounded(quality.run_report(land.run_log(spark, sf_dir)), 4)


# weights, splits, resampling -------------------------------------------------------

@query
def class_weights(spark, sf_dir):
    return rounded(weights.class_weights(land.class_labels(spark, sf_dir)))


@query
def class_weighted(spark, sf_dir):
    return rounded(weights.add_class_weight(land.class_labels(spark, sf_dir)))


@query
def hash_split(spark, sf_dir):
    pixels = _obs(spark, sf_dir).select(*CELL).distinct()
    return splits.hash_split(pixels, CELL)


@query
def stratified_split(spark, sf_dir):
    return splits.stratified_split(land.class_labels(spark, sf_dir), "label", ["doc_id"])


@query
def zone_split(spark, sf_dir):
    rows = splits.zone_split(_class_rows(spark, sf_dir).where("label <> -1"), [3])
    return rows.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def undersample(spark, sf_dir):
    return splits.undersample(land.class_labels(spark, sf_dir), "label", ["doc_id"])


@query
def oversample(spark, sf_dir):
    return splits.oversample(land.class_labels(spark, sf_dir), "label", ["doc_id"])


@query
def grouped_folds(spark, sf_dir):
    """Labelled pixels in folds of 8 x 8 blocks."""
    rows = _class_rows(spark, sf_dir).where("label <> -1")
    return splits.grouped_folds(rows, "label", block=8)


@query
def oversample_interpolated(spark, sf_dir):
    """The rarer of two greenness classes filled up with rows between neighbours."""
    medians = temporal_composite(_obs(spark, sf_dir), bands=("b03", "b04", "ndvi"))
    rows = medians.select(*CELL, *(F.round(f"{b}_med", 9).alias(b) for b in ("b03", "b04", "ndvi")))
    classed = stage(rows.withColumn("label", (F.col("ndvi") > 0.25).cast("int")), "classed")
    return rounded(neighbours.oversample_interpolated(classed, "label", CELL, ["b03", "b04", "ndvi"], 0.8, 3, block_rows=64), 10)


# metrics ---------------------------------------------------------------------------

@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(land.scored(spark, sf_dir))


@query
def weighted_metrics(spark, sf_dir):
    return rounded(metrics.weighted_metrics(metrics.confusion_matrix(land.scored(spark, sf_dir))))


@query
def class_metrics(spark, sf_dir):
    return rounded(metrics.class_metrics(metrics.confusion_matrix(land.scored(spark, sf_dir))))


def _areas(spark, sf_dir, name):
    return rounded(metrics.threshold_areas(metrics.score_totals(land.scored(spark, sf_dir))).select(name))


@query
def roc_auc(spark, sf_dir):
    return _areas(spark, sf_dir, "roc_auc")


@query
def average_precision(spark, sf_dir):
    return _areas(spark, sf_dir, "average_precision")


@query
def area_under_pr(spark, sf_dir):
    return _areas(spark, sf_dir, "area_under_pr")


@query
def roc_curve(spark, sf_dir):
    return rounded(metrics.roc_points(metrics.score_totals(land.scored(spark, sf_dir))))


@query
def pr_curve(spark, sf_dir):
    return rounded(metrics.pr_points(metrics.score_totals(land.scored(spark, sf_dir))))


@query
def threshold_sweep(spark, sf_dir):
    return rounded(metrics.threshold_sweep(land.scored(spark, sf_dir), [i / 20 for i in range(21)]))


@query
def metric_grades(spark, sf_dir):
    return metrics.metric_grades(metrics.evaluation(land.scored(spark, sf_dir)))


# models ----------------------------------------------------------------------------

# Published points: single fits take the first of each range, searches two of them a family.
RF_POINT = {"numTrees": 200, "maxDepth": 10, "maxBins": 64, "featureSubsetStrategy": "sqrt"}
GBT_POINT = {"maxDepth": 6, "maxBins": 64, "maxIter": 100, "stepSize": 0.1}
RF_POINTS = {k: [v] for k, v in RF_POINT.items()} | {"featureSubsetStrategy": ["sqrt", "log2"]}
GBT_POINTS = {k: [v] for k, v in GBT_POINT.items()} | {"stepSize": [0.1, 0.2]}


def _ml_rows(spark, sf_dir):
    """Composite with signal label, stored split and training-share weights, materialised."""
    composite = temporal_composite(_obs(spark, sf_dir))
    rows = stage(splits.hash_split(land.signal_labels(composite), CELL), "ml_rows")
    return weights.add_class_weight(rows, fit_on=rows.where("split = 'train'"))


def _fit(rows, family, **params):
    train = rows.where("split = 'train'")
    return models.refit(train, dataset.feature_columns(rows), family, params)


def _predictions(model, rows):
    return models.score(model, rows.where("split = 'test'")).select(*CELL, "label", "score", "prediction")


@query
def rf_predictions(spark, sf_dir):
    rows = _ml_rows(spark, sf_dir)
    return _predictions(_fit(rows, "RandomForest", **RF_POINT), rows)


@query
def gbt_predictions(spark, sf_dir):
    rows = _ml_rows(spark, sf_dir)
    return _predictions(_fit(rows, "GBT", **GBT_POINT), rows)


@query
def rf_fixed(spark, sf_dir):
    rows = _ml_rows(spark, sf_dir)
    return metrics.evaluation(models.score(jobs.fixed_forest(rows), rows.where("split = 'test'")))


@query
def champion(spark, sf_dir):
    composite = land.signal_labels(temporal_composite(_obs(spark, sf_dir)))
    result = jobs.train_models(composite, CELL, {"RandomForest": RF_POINTS, "GBT": GBT_POINTS})
    return jobs.summary_row(spark, result)


@query
def cross_validated(spark, sf_dir):
    """Best forest of a search over five spatial folds, scored on the held-out rows."""
    rows = _ml_rows(spark, sf_dir)
    folded = splits.grouped_folds(rows.where("split = 'train'"), "label", block=8)
    train = folded.persist()
    model, _, _ = models.tune(
        train, dataset.feature_columns(rows), "RandomForest", RF_POINTS, method="folds", folds=5, fold_col="fold"
    )
    train.unpersist()
    return metrics.evaluation(models.score(model, rows.where("split = 'test'")))


@query
def evaluation_job(spark, sf_dir):
    """Saved model, reloaded and evaluated on the stored test rows; metrics read back."""
    rows = _ml_rows(spark, sf_dir)
    root = staging_path(spark, "evaluation")
    sinks.save_model(_fit(rows, "RandomForest", **RF_POINT), f"{root}/model")
    jobs.evaluate_model(spark, f"{root}/model", rows, f"{root}/out")
    return spark.read.json(f"{root}/out/metrics")


@query
def top_features(spark, sf_dir):
    rows = _ml_rows(spark, sf_dir)
    return models.top_features(models.importances(_fit(rows, "RandomForest", **RF_POINT)), 10)


@query
def model_leaderboard(spark, sf_dir):
    """Summaries of two saved runs, read back and ranked."""
    composite = stage(land.signal_labels(temporal_composite(_obs(spark, sf_dir))), "composite")
    root = staging_path(spark, "runs")
    for name, grid in (("rf", {"RandomForest": RF_POINTS}), ("gbt", {"GBT": GBT_POINTS})):
        jobs.save_run(spark, jobs.train_models(composite, CELL, grid), f"{root}/{name}")
    return jobs.leaderboard(spark, f"{root}/*/metrics/summary").drop("path")


@query
def predict_zone(spark, sf_dir):
    rows = _ml_rows(spark, sf_dir)
    model = _fit(rows.where("zone <> 3"), "RandomForest", **RF_POINT)
    return jobs.predict_zones(model, rows.where("zone = 3"))


@query
def vote_ensemble(spark, sf_dir):
    rows = _ml_rows(spark, sf_dir)
    fitted = [_fit(rows, "RandomForest", **RF_POINT), _fit(rows, "GBT", **GBT_POINT)]
    voted = models.vote(fitted, rows.where("split = 'test'"))
    return voted.select(*CELL, "label", "score", "prediction")


@query
def learning_curve(spark, sf_dir):
    rows = _ml_rows(spark, sf_dir)
    return models.learning_curve(
        rows.where("split = 'train'"), rows.where("split = 'test'"),
        dataset.feature_columns(rows), CELL, **RF_POINT,
    )


# selection and files, on tables that SQL can follow -----------------------------------

def _two_scores(spark, sf_dir):
    """Two scores per look, each missing for some, and the label."""
    px = _px(spark, sf_dir)
    return px.select(
        *CELL, (F.col("b04") > 0.5).cast("int").alias("label"), F.when(~F.col("scl").isin(1, 3), F.round(F.col("b03"), 6)).alias("score_0"),
        F.when(F.col("scl") > 1, F.round(F.col("b8a"), 6)).alias("score_1"),
    )


@query
def vote_scores(spark, sf_dir):
    """Mean vote of two score columns over the looks of a zone and class."""
    voted = _two_scores(spark, sf_dir).withColumns(models.mean_vote(["score_0", "score_1"], 0.4))
    return rounded(voted.groupBy("zone", "label").agg(
        F.sum("score").alias("score"), F.sum("prediction").cast("long").alias("n_positive"), F.count_if(F.col("score").isNull()).alias("n_without")
    ), 4)


@query
def ranked_features(spark, sf_dir):
    """The ten columns that spread most, ranked as importances are."""
    spread = _px(spark, sf_dir).agg(*(F.round(F.stddev_pop(b), 6).alias(b) for b in FEATURES))
    table = spread.unpivot([], list(FEATURES), "feature", "importance")
    return models.top_features(table, 10)


@query
def family_choices(spark, sf_dir):
    """Per zone the family whose score agrees more often with the label; ties go to boosting."""
    rows = _two_scores(spark, sf_dir).where("score_0 IS NOT NULL AND score_1 IS NOT NULL")
    right = lambda c: F.round(F.avg(((F.col(c) >= 0.5).cast("int") == F.col("label")).cast("double")), 1)
    both = rows.groupBy("zone").agg(right("score_0").alias("RandomForest"), right("score_1").alias("GBT"))
    return models.choices(both.unpivot(["zone"], ["RandomForest", "GBT"], "family", "metric"), ["zone"])


@query
def leaderboard_saved(spark, sf_dir):
    """Run summaries saved as JSON, one folder per zone, read back and ranked."""
    root = staging_path(spark, "saved")
    scored = land.scored(spark, sf_dir).withColumn("run", F.floor(F.col("score") * 10) % 3)
    share = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    runs = scored.groupBy("run").agg(
        F.map_from_arrays(F.array(*map(F.lit, ("accuracy", "weighted_f1", "roc_auc"))),
                          F.array(F.round(share, 9), F.round(F.avg("label"), 9), F.round(F.avg("score"), 9))).alias("test_metrics"),
        F.first(F.lit("RandomForest")).alias("winner"), F.first(F.lit(15)).alias("n_features"),
    )
    for run in range(3):
        sinks.write_json(runs.where(F.col("run") == run).drop("run"), f"{root}/run{run}/metrics/summary")
    return jobs.leaderboard(spark, f"{root}/*/metrics/summary").drop("path")


@query
def csv_read_back(spark, sf_dir):
    """Zone statistics written as CSV and read back."""
    path = staging_path(spark, "csv")
    table = rounded(dataset.zone_stats(_class_rows(spark, sf_dir).where("label <> -1")))
    sinks.write_table(table, path, "csv")
    return spark.read.option("header", True).schema(table.schema).csv(path)


@query
def json_read_back(spark, sf_dir):
    """Nested quarantine entries written as JSON and read back."""
    path = staging_path(spark, "json")
    table = quality.quarantine(land.product_meta(spark, sf_dir))
    sinks.write_json(table, path)
    return spark.read.schema(table.schema).json(path)


@query
def scene_read_back(spark, sf_dir):
    """One zone's latest scene out of the scene table on disk."""
    path = staging_path(spark, "scenes")
    sinks.write_scenes(_px(spark, sf_dir).select(*CELL, "scene", "ts", *FEATURES), path)
    stored = spark.read.parquet(path).where("zone = 2")
    last = stored.agg(F.max("scene")).first()[0]
    return rounded(stored.where(F.col("scene") == F.lit(last)))


@query
def feature_names(spark, sf_dir):
    """Columns that training takes as features."""
    rows = splits.hash_split(_training(spark, sf_dir), CELL)
    names = dataset.feature_columns(rows)
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.posexplode(F.array(*map(F.lit, names))).alias("place", "feature"), "n_rows")


@query
def report_lines(spark, sf_dir):
    """Count and class lines of the Markdown report of a saved evaluation."""
    path = staging_path(spark, "report")
    evaluation = metrics.evaluation(land.scored(spark, sf_dir))
    spread = _px(spark, sf_dir).agg(*(F.stddev_pop(b).alias(b) for b in FEATURES)).unpivot([], list(FEATURES), "feature", "importance")
    sinks.write_text(spark, evaluation_report(evaluation, spread, "Vote"), path)
    lines = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", "\n")).alias("line"))
    cells = F.split(F.trim(F.btrim("line", F.lit("|"))), " \\| ")
    return lines.where("line RLIKE '^\\\\| (counts|class|[0-9])'").select(
        F.trim(cells[0]).alias("part"), F.trim(cells[1]).alias("name"), F.trim(cells[2]).alias("value")
    )


# Names under which functions that would shadow an operator are registered.
for _name in [n for n in _REGISTRY if n.endswith("_query")]:
    _REGISTRY[_name.removesuffix("_query")] = _REGISTRY.pop(_name)
