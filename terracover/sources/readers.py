"""Table readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_union(spark: SparkSession, inputs: str) -> DataFrame:
    """Parquet tables from a comma list of paths or globs, united by column name.

    Columns missing from a table are NULL.
    """
    paths = [p.strip() for p in inputs.split(",") if p.strip()]
    if not paths:
        raise ValueError("no input path given")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), map(spark.read.parquet, paths)
    )


def read_zones(spark: SparkSession, root: str, tolerant: bool = False) -> DataFrame:
    """One table partitioned by ``zone``; ``tolerant`` skips unreadable files, see :func:`zone_status`."""
    return (
        spark.read.option("mergeSchema", "true")
        .option("ignoreCorruptFiles", str(tolerant).lower())
        .parquet(root)
    )


def zone_status(spark: SparkSession, root: str) -> DataFrame:
    """Per zone folder: files, files that gave no row, rows, and ``ok``, ``partial`` or ``unreadable``.

    Listed files are met with the files a tolerant read took rows from; an empty file counts
    as unreadable.
    """
    plain = lambda path: F.regexp_replace(F.url_decode(path), "^[a-z0-9]+:/+", "/")
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
        .load(root).select(plain(F.col("path")).alias("path"))
    )
    read = (
        read_zones(spark, root, tolerant=True).select(plain(F.input_file_name()).alias("from"))
        .groupBy("from").agg(F.count(F.lit(1)).alias("rows"))
    )
    met = listed.join(read, F.col("path") == F.col("from"), "left")
    zones = met.groupBy(F.regexp_extract("path", "/zone=([^/]+)/", 1).alias("zone")).agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("rows").isNull()).alias("n_unreadable"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
    )
    status = F.when(F.col("n_unreadable") == 0, "ok").when(F.col("n_rows") > 0, "partial").otherwise("unreadable")
    return zones.withColumn("status", status)


def raster_to_pixels(blocks: DataFrame, keys, bands, width: int, nodata: float | None = 0.0) -> DataFrame:
    """Row-major band arrays to one row per pixel; drops nodata of the first band."""
    pixels = blocks.select(
        *keys, F.posexplode(F.arrays_zip(*(F.col(b) for b in bands))).alias("at", "v")
    ).select(
        *keys,
        F.expr(f"CAST(at DIV {width} AS INT)").alias("r"),
        F.expr(f"CAST(at % {width} AS INT)").alias("c"),
        *(F.col(f"v.{b}").alias(b) for b in bands),
    )
    if nodata is None:
        return pixels
    return pixels.where(F.col(bands[0]) != F.lit(nodata))
