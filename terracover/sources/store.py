"""Stored pixel tables: sorted files whose row groups are skipped, buckets that meet without a shuffle.

Sorted files are for reading a part: rows lie in (zone, r, c) order, so the bounds of a
layer, known before the read, become static predicates and row groups outside them are
never decoded.

Buckets are for reading all: tables that share keys and number of buckets keep the rows of a
cell in the same bucket, one sorted file each, so joins and groupings on the cell need no
exchange. The number of buckets follows the counted rows of the largest table.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracover.operators.joins import lookup_join
from terracover.sources.staging import staging_path

CELL = ("zone", "r", "c")
# Rows of a bucket, a power of two, so that numbers of buckets of two tables divide each other.
BUCKET_ROWS = 1 << 22
# Static predicates of one read; more zones share bounds.
MOST_BOUNDS = 200


def write_sorted(px: DataFrame, path: str, keys=CELL, row_group_bytes: int | None = None) -> None:
    """Rows in key order across and within files; ``row_group_bytes`` is the unit that reads can skip."""
    writer = px.repartitionByRange(*keys).sortWithinPartitions(*keys).write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def layer_bounds(edges: DataFrame, extent: DataFrame, most: int = MOST_BOUNDS) -> list[tuple]:
    """(first zone, last zone, r from, r to, c from, c to) that hold every cell of the edges inside the grids.

    One entry per zone; beyond ``most`` zones neighbours share one, so the list stays short.
    """
    first, last = lambda v: F.ceil(F.min(v) - 0.5), lambda v: F.ceil(F.max(v) - 0.5) - 1
    ys, xs = F.explode(F.array("y1", "y2")), F.explode(F.array("x1", "x2"))
    rows = edges.select("zone", ys.alias("y")).groupBy("zone").agg(first("y").alias("r0"), last("y").alias("r1"))
    columns = edges.select("zone", xs.alias("x")).groupBy("zone").agg(first("x").alias("c0"), last("x").alias("c1"))
    clipped = lookup_join(rows.join(columns, "zone"), extent, "zone").select(
        "zone", F.greatest("r0", F.lit(0)).alias("r0"), F.least("r1", F.col("height") - 1).alias("r1"),
        F.greatest("c0", F.lit(0)).alias("c0"), F.least("c1", F.col("width") - 1).alias("c1"),
    ).where("r0 <= r1 AND c0 <= c1")
    # One row per zone is left, so one window holds them all.
    shared = clipped.withColumn("of", F.ntile(most).over(Window.orderBy("zone"))).groupBy("of").agg(
        F.min("zone").alias("z0"), F.max("zone").alias("z1"), F.min("r0").alias("r0"), F.max("r1").alias("r1"),
        F.min("c0").alias("c0"), F.max("c1").alias("c1"),
    )
    return [tuple(r)[1:] for r in shared.orderBy("of").collect()]


def within(px: DataFrame, bounds: list[tuple]) -> DataFrame:
    """Rows inside one of the bounds, as literals that reach the file scan; no bounds, no rows."""
    def inside(z0, z1, r0, r1, c0, c1) -> Column:
        zone = F.col("zone") == z0 if z0 == z1 else F.col("zone").between(z0, z1)
        return zone & F.col("r").between(int(r0), int(r1)) & F.col("c").between(int(c0), int(c1))

    return px.where(reduce(lambda a, b: a | b, (inside(*b) for b in bounds), F.lit(False)))


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """A power of two that leaves at most ``bucket_rows`` in an even bucket."""
    return max(least, 1 << max(0, (max(1, rows) - 1).bit_length() - (bucket_rows.bit_length() - 1)))


def store_buckets(df: DataFrame, buckets: int, keys=CELL, name: str = "pixels", path: str | None = None) -> DataFrame:
    """``df`` written once as a table bucketed and sorted by ``keys``, one file per bucket, and read back.

    Files go to ``path`` or the staging folder; the table's name lives as long as the session.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, *keys)  # the hash that assigns buckets
    (
        rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
        .option("path", path or staging_path(spark, table)).saveAsTable(table)
    )
    return spark.table(table)

