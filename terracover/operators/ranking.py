"""Running totals and heavy-group detection that hold for any key distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracover.operators.joins import null_safe_join
from terracover.sources.staging import stage

# Rows of one group that a single task may hold in memory.
GROUP_LIMIT = 100_000


def largest_group(df: DataFrame, keys) -> int:
    """Rows of the largest ``keys`` group (all rows without keys)."""
    counted = df.groupBy(*keys).count()
    return counted.agg(F.max("count")).first()[0] or 0


def heavy_groups(df: DataFrame, keys, limit: int = GROUP_LIMIT) -> DataFrame | None:
    """Keys with more than ``limit`` rows as a staged table, or None if there are none.

    At most ``rows / limit`` keys qualify. One pass over ``df``.
    """
    heavy = stage(df.groupBy(*keys).count().where(F.col("count") > limit).select(*keys), "heavy")
    return None if heavy.isEmpty() else heavy


def running_totals(
    df: DataFrame, keys, order: str, sums, descending: bool = False, limit: int = GROUP_LIMIT,
    bounded: bool = False,
) -> DataFrame:
    """Add ``cum_<s>`` (inclusive, in ``order``) and ``total_<s>`` per ``keys`` group.

    ``df`` must be pre-aggregated to one row per ``(keys, order)``. Groups within
    ``limit`` use one window; ``bounded`` states that this holds and skips the check.
    A larger group is range-partitioned into slices on ``(keys, order)``, each slice is
    summed on its own, and the slice offsets (at most one row per slice and key) are
    joined back, so no task holds a whole group.
    """
    keys, sums = list(keys), list(sums)
    table, largest = df, 0
    if not bounded:
        table = stage(df, "totals")
        largest = largest_group(table, keys)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    if largest <= limit:
        group = Window.partitionBy(*keys)
        upto = group.orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
        return table.select(
            "*",
            *(F.sum(s).over(upto).alias(f"cum_{s}") for s in sums),
            *(F.sum(s).over(group).alias(f"total_{s}") for s in sums),
        )

    sliced = stage(
        table.repartitionByRange(*(F.col(k) for k in keys), direction).withColumn(
            "slice", F.spark_partition_id()
        ),
        "slices",
    )
    group = Window.partitionBy(*keys)
    before = group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "slice")
        .agg(*(F.sum(s).alias(f"part_{s}") for s in sums))
        .select(
            *keys,
            "slice",
            *(F.coalesce(F.sum(f"part_{s}").over(before), F.lit(0)).alias(f"offset_{s}") for s in sums),
            *(F.sum(f"part_{s}").over(group).alias(f"total_{s}") for s in sums),
        )
    )
    within = (
        Window.partitionBy(*keys, "slice").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    )
    return null_safe_join(sliced, offsets, [*keys, "slice"]).select(
        *df.columns,
        *((F.sum(s).over(within) + F.col(f"offset_{s}")).alias(f"cum_{s}") for s in sums),
        *(f"total_{s}" for s in sums),
    )
