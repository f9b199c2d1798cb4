"""Table, report and model writers; every output goes through Spark's file writers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.operators import tiles


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=()) -> None:
    """Overwrite a parquet or csv table."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        raise ValueError(f"unknown table format: {fmt}")


def write_zones(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Pixel rows in one folder per zone.

    Tasks take contiguous ranges of (zone, r, c): a zone with most of the rows is written
    by many tasks, small zones share one, and files stay few.
    """
    write_table(df.repartitionByRange("zone", "r", "c"), path, fmt, partition_by=["zone"])


def write_scenes(px: DataFrame, path: str) -> None:
    """Scene pixels by zone and scene, sorted by cell so row groups prune on position."""
    order = ("zone", "scene", "r", "c")
    write_table(px.repartitionByRange(*order).sortWithinPartitions(*order), path, partition_by=["zone", "scene"])


def write_blocks(px: DataFrame, path: str, keys, bands, size: int = tiles.SIZE, nodata: float = 0.0) -> None:
    """Scene pixels as tiled blocks (see ``operators.tiles``) in tile order, a folder per first key."""
    blocks = tiles.pixels_to_blocks(px, keys, bands, size, nodata)
    order = [*keys, "tile_r", "tile_c"]
    write_table(blocks.repartitionByRange(*order).sortWithinPartitions(*order), path, partition_by=list(keys)[:1])


def write_json(df: DataFrame, path: str) -> None:
    """One JSON document per row."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def write_text(spark, text: str, path: str) -> None:
    """A rendered report as one text file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
