"""Land-cover views of the driver tables.

Every view is derived from a driver table and grows with it: five zones, 40 columns
per zone, and one grid row per 50 parts, so observations per pixel stay constant while
pixels grow linearly with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracover.functions.hashing import key_digest, unit_interval
from terracover.functions.spectral import BANDS, scale_bands, with_indices
from terracover.operators.joins import lookup_join

CELL = ("zone", "r", "c")
BLOCK_ROWS = 40

# Polygon vertices (x = column, y = row) of one 40-row block.
PARCELS = {
    ("forest", 1): ((2.3, 3.1), (30.2, 5.4), (25.7, 33.6), (6.4, 28.9)),
    ("forest", 2): ((20.1, 20.2), (38.3, 22.7), (36.9, 37.4), (22.8, 35.3)),
    ("perimeter", 3): ((0.2, 1.3), (39.1, 0.7), (38.8, 36.2), (1.7, 39.4)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scene_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw digital numbers: one row per pixel look, classes in ``scl``."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_suppkey % 5 AS INT) AS zone",
        "CAST((l_partkey - 1) DIV 50 AS INT) AS r",
        "CAST(l_orderkey % 40 AS INT) AS c",
        "l_shipdate AS ts",
        "year(l_shipdate) AS scene",
        "l_tax * 125000 AS dn_b02",
        "l_discount * 100000 AS dn_b03",
        "l_extendedprice / 10 AS dn_b04",
        "(l_discount * 100000 + l_extendedprice / 10) / 2 AS dn_b05",
        "CAST((l_partkey * 7 + l_orderkey) % 9001 AS DOUBLE) AS dn_b06",
        "CAST((l_orderkey * 13 + l_linenumber * 101) % 10001 AS DOUBLE) AS dn_b07",
        "(l_quantity - 1) * 204 AS dn_b8a",
        "CAST((l_suppkey * 37 + l_partkey) % 8001 AS DOUBLE) AS dn_b11",
        "CAST((l_orderkey + l_partkey) % 7001 AS DOUBLE) AS dn_b12",
        "CAST((l_orderkey + l_linenumber) % 12 AS INT) AS scl",
    )


def reflectances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene pixels with scaled bands and both indices."""
    return with_indices(scale_bands(scene_pixels(spark, sf_dir)))


def zone_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid height and width of each zone."""
    return (
        scene_pixels(spark, sf_dir)
        .groupBy("zone")
        .agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))
    )


def vertices(spark: SparkSession, sf_dir: str, extent: DataFrame | None = None) -> DataFrame:
    """Polygon vertices: the parcels repeated in every 40-row block of every zone."""
    corners = F.array(
        *(
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(poly).alias("base_id"),
                F.lit(seq).alias("seq"),
                F.lit(x).alias("x"),
                F.lit(y).alias("y0"),
            )
            for (layer, poly), ring in PARCELS.items()
            for seq, (x, y) in enumerate(ring)
        )
    )
    zones = zone_extent(spark, sf_dir) if extent is None else extent
    blocks = zones.select(
        "zone", F.explode(F.expr(f"sequence(0, CAST(ceil(height / {BLOCK_ROWS}) AS INT) - 1)")).alias("block")
    )
    return (
        blocks.repartition("zone", "block")
        .select("zone", "block", F.explode(corners).alias("v"))
        .select(
            "zone",
            "v.layer",
            (F.col("block") * 10 + F.col("v.base_id")).alias("poly_id"),
            "v.seq",
            "v.x",
            (F.col("v.y0") + F.col("block") * F.lit(float(BLOCK_ROWS))).alias("y"),
        )
    )


_TILE = "element_at(array('18NWL','18LWL','19NBA'), CAST(l_suppkey % 3 AS INT) + 1)"
_STAMP = "date_format(l_shipdate, \"yyyyMMdd'T'HHmmss\")"
_ZONE_NAME = "concat('zone', CAST(l_suppkey % 5 AS STRING))"
_PRODUCT = (
    "concat('S2', CASE WHEN l_orderkey % 2 = 0 THEN 'A' ELSE 'B' END, '_MSIL2A_', "
    f"{_STAMP}, '_N0500_R', lpad(CAST(l_suppkey % 143 AS STRING), 3, '0'), '_T', {_TILE}, '_', {_STAMP})"
)


def product_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys of satellite products: one band file per line item."""
    band = (
        "element_at(array('B02','B03','B04','B05','B06','B07','B8A','B11','B12'), "
        "l_linenumber + CAST(l_orderkey % 3 AS INT))"
    )
    res = "CASE WHEN l_quantity >= 46 THEN '60' ELSE '20' END"
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"concat({_ZONE_NAME}, '/', {_PRODUCT}, '.SAFE/GRANULE/L2A_T', {_TILE}, '/IMG_DATA/R', {res}, "
        f"'m/T', {_TILE}, '_', {_STAMP}, '_', {band}, '_', {res}, 'm.jp2') AS path"
    )


def product_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per product with what its files say about grid, bounds and overlap."""
    named = table(spark, sf_dir, "lineitem").selectExpr(
        f"{_ZONE_NAME} AS zone", f"{_PRODUCT} AS product", f"{_TILE} AS tile",
        "l_partkey", "l_suppkey", "l_quantity", "l_tax",
    )
    return named.groupBy("zone", "product", "tile").agg(
        F.expr(
            "CASE WHEN max(l_partkey) % 5 = 0 THEN 'EPSG:32617' WHEN tile = '18LWL' THEN 'EPSG:32718' "
            "WHEN tile = '19NBA' THEN 'EPSG:32619' ELSE 'EPSG:32618' END"
        ).alias("file_crs"),
        F.expr("CASE WHEN max(l_suppkey) % 7 = 0 THEN -80.5D ELSE -75D END").alias("left"),
        F.expr("CASE WHEN zone = 'zone4' THEN 14.5D ELSE 6D END").alias("bottom"),
        F.expr("CASE WHEN max(l_suppkey) % 7 = 0 THEN -80D ELSE -74.5D END").alias("right"),
        F.expr("CASE WHEN zone = 'zone4' AND max(l_partkey) % 2 = 0 THEN 15.5D ELSE 6.5D END").alias("top"),
        F.count_if(F.col("l_quantity") > 5).alias("n_overlap"),
        (F.min("l_tax") >= 0.08).alias("clip_failed"),
    ).drop("tile")


def asset_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of scene rasters and polygon layer files under one folder per nation."""
    layers = table(spark, sf_dir, "supplier").selectExpr(
        "concat('zone', CAST(s_nationkey AS STRING), '/', CASE s_suppkey % 3 WHEN 0 THEN 'Bosque.shp' "
        "WHEN 1 THEN 'Perímetro.shp' ELSE 'Bosque.dbf' END) AS path"
    )
    rasters = table(spark, sf_dir, "customer").selectExpr(
        "concat('zone', CAST(c_nationkey AS STRING), '/', CAST(c_custkey AS STRING), "
        "CASE WHEN c_acctbal > 0 THEN '_procesado.tif' ELSE '_meta.xml' END) AS path"
    )
    return layers.unionByName(rasters)


def raster_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-band 8 x 8 raster blocks in row-major arrays."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("block"),
        F.col("embedding").alias("band_1"),
        F.reverse("embedding").alias("band_2"),
    )


def scene_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid extent and north-up affine transform per zone."""
    return zone_extent(spark, sf_dir).selectExpr(
        "zone", "height", "width",
        "0.0002D AS a", "-0.0002D AS e", "-75D + zone * 0.1D AS x0",
        "CASE WHEN zone = 4 THEN 20D ELSE 6D + zone * 0.1D END AS y0",
    )


def utm_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement of each zone's 20 m grid in UTM, two zones south of the equator."""
    return zone_extent(spark, sf_dir).selectExpr(
        "zone", "height", "width", "18 + zone % 2 AS utm_zone", "zone >= 3 AS south",
        "500000D + zone * 20000D AS east0",
        "CASE WHEN zone >= 3 THEN 9900000D ELSE 600000D END AS north0", "20D AS pixel",
    )


def scene_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grids of :func:`utm_scenes` with their reference code and affine terms."""
    return utm_scenes(spark, sf_dir).selectExpr(
        "zone", "height", "width", "CASE WHEN south THEN 32700 ELSE 32600 END + utm_zone AS grid_epsg",
        "pixel AS a", "0D AS b", "east0 AS c", "0D AS d", "-pixel AS e", "north0 AS f",
    )


# Corners of a parcel around its centre, and the inner ring of every third one.
OCTAGON = ((1.0, 0.0), (0.7, 0.7), (0.0, 1.0), (-0.7, 0.7), (-1.0, 0.0), (-0.7, -0.7), (0.0, -1.0), (0.7, -0.7))
HOLE = 0.4


def georeferenced_rings(spark: SparkSession, sf_dir: str, grids: DataFrame) -> DataFrame:
    """Polygon vertices with codes: a forest parcel per supplier in degrees, perimeters in metres."""
    corners = F.array(*(F.struct(F.lit(i).alias("seq"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for i, (dx, dy) in enumerate(OCTAGON)))
    rings = F.expr(f"CASE WHEN s_suppkey % 3 = 0 THEN array(1D, {HOLE}D) ELSE array(1D) END")
    sized = table(spark, sf_dir, "supplier").select(F.expr("CAST(s_suppkey % 5 AS INT) AS zone"), "s_suppkey", "s_nationkey")
    forest = (
        lookup_join(sized, grids.select("zone", "height", "width"), "zone")
        .select("*", F.posexplode(rings).alias("ring", "scale")).select("*", F.explode(corners).alias("v"))
        .withColumns({
            "x": F.expr("s_suppkey * 29 % width + 0.41D + (1.7D + s_nationkey % 6) * scale * v.dx"),
            "y": F.expr("s_suppkey * 13 % height + 0.37D + (1.7D + s_nationkey % 6) * scale * v.dy"),
        })
        .select(
            "zone", F.lit("forest").alias("layer"), F.col("s_suppkey").cast("int").alias("poly_id"), "ring", "v.seq",
            F.expr("-75D + zone % 2 * 6 + zone * 0.18D + x * 0.00018D").alias("x"),
            F.expr("CASE WHEN zone >= 3 THEN -0.9045D ELSE 5.4284D END - y * 0.00018D").alias("y"), F.lit(4326).alias("epsg"),
        )
    )
    perimeter = lookup_join(vertices(spark, sf_dir, grids.select("zone", "height", "width")).where("layer = 'perimeter'"),
                            grids.select("zone", "grid_epsg", "a", "c", "e", "f"), "zone").select(
        "zone", "layer", "poly_id", F.lit(0).alias("ring"), "seq",
        (F.col("c") + F.col("a") * F.col("x")).alias("x"), (F.col("f") + F.col("e") * F.col("y")).alias("y"), F.col("grid_epsg").alias("epsg"),
    )
    return forest.unionByName(perimeter)


def cell_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest reading of every band and index per occupied cell, as resampling source."""
    pixels = reflectances(spark, sf_dir)
    return pixels.groupBy(*CELL).agg(*(F.max(b).alias(b) for b in (*BANDS, "ndvi", "ndwi")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled scores for the metric operators, one per pixel look."""
    return (
        reflectances(spark, sf_dir)
        .select(
            (F.col("b04") > 0.5).cast("int").alias("label"),
            F.round(F.col("b04") * 0.3 + F.col("b8a") * 0.7, 3).alias("score"),
        )
        .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    )


def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-step run entries; ``error`` marks a failed step."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS run_id",
        "CAST(user_id % 15 AS INT) AS zone",
        "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'timeout' "
        "WHEN 'purchase' THEN 'exception' ELSE 'success' END AS status",
        "CASE WHEN event_type = 'error' THEN element_at(array('03_features','04_labels','05_union'), "
        "CAST(event_id % 3 AS INT) + 1) END AS failed_step",
        "value AS duration",
    )


def signal_labels(composite: DataFrame) -> DataFrame:
    """Composite with a noisy NDVI label, the table the models are trained on."""
    noise = unit_interval(key_digest(7, *CELL)) - 0.5
    return composite.withColumn("label", (F.col("ndvi_med") + 0.3 * noise > 0).cast("int"))
