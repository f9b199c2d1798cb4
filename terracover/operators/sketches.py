"""Mergeable quantile sketches of scenes, for thresholds that follow new files without the old pixels.

Readings in [0, 1] become codes of 16 bits, the leaves of a binary tree. A sketch keeps counts
at nodes of the tree: from the leaves up, two siblings and their parent are merged into the
parent while they hold at most a ``k``-th of the group together (the rule of the q-digest of
Shrivastava et al., 2004). Counts above the leaves are then at most a ``k``-th each, so a rank
is off by at most 16 / k of the group, a sketch has at most about 3 k nodes, and sketches merge
by adding their counts and compressing again, in any order, with the same bound. Groups of
fewer than ``k`` readings are exact. Nothing is drawn at random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracover.operators.masks import CLOUD_QUANTILE, NDVI_CLOUD, SCENE, SHADOW_QUANTILE, class_clear

BITS = 16
TOP = (1 << BITS) - 1
K = 3200


def code_of(value: Column) -> Column:
    """Leaf of a reading, which is cut to [0, 1]; half a leaf is what rounding may move it."""
    return F.floor(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)) * TOP + 0.5).cast("int")


def rank_bound(k: int) -> float:
    """Largest error of a rank, as a share of the group."""
    return BITS / k


def compress(nodes: DataFrame, keys, k: int = K) -> DataFrame:
    """(keys, level, node, n): counts merged upwards; rows of equal nodes are added.

    All steps sort within the partition of a group, which holds at most 2 ** 16 leaves and
    what was kept above them, so there is one shuffle.
    """
    keys = list(keys)
    table = nodes.groupBy(*keys, "level", "node").agg(F.sum("n").alias("n")).repartition(*keys)
    table = table.withColumn("most", F.floor(F.sum("n").over(Window.partitionBy(*keys)) / k))
    for level in range(BITS):
        here = F.col("level") == level
        parent = F.when(here, F.shiftright("node", 1)).when(F.col("level") == level + 1, F.col("node"))
        table = table.withColumn("parent", parent).withColumn("family", F.sum("n").over(Window.partitionBy(*keys, "parent")))
        up = here & (F.col("family") <= F.col("most"))
        table = table.withColumns({"node": F.when(up, F.col("parent")).otherwise(F.col("node")), "level": F.when(up, level + 1).otherwise(F.col("level"))})
    return table.groupBy(*keys, "level", "node").agg(F.sum("n").alias("n"))


def sketch(df: DataFrame, keys, value: str, k: int = K) -> DataFrame:
    """Sketch of ``value`` per group; NULL and NaN are left out."""
    keys = list(keys)
    readings = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    leaves = readings.groupBy(*keys, code_of(F.col(value)).alias("node")).agg(F.count(F.lit(1)).alias("n"))
    return compress(leaves.select(*keys, F.lit(0).alias("level"), "node", "n"), keys, k)


def merge(sketches, keys, k: int = K) -> DataFrame:
    """One sketch per group from several tables of sketches."""
    first, *rest = sketches
    for other in rest:
        first = first.unionByName(other)
    return compress(first, keys, k)


def quantile(nodes: DataFrame, keys, wanted: dict[str, float]) -> DataFrame:
    """Readings at the wanted shares of each group: the upper end of the node that holds the rank."""
    keys = list(keys)
    group = Window.partitionBy(*keys)
    ordered = nodes.withColumn("upper", F.expr("shiftleft(node + 1, level) - 1"))
    order = group.orderBy("upper", "level").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ordered.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(group)})
    picks = [
        (F.min(F.when(F.col("upto") > F.floor(q * (F.col("total") - 1)), F.col("upper"))) / TOP).alias(name) for name, q in wanted.items()
    ]
    return ranked.groupBy(*keys).agg(*picks)


def scene_sketches(px: DataFrame, keys=SCENE, exclude_water: bool = False, ndvi_cloud: float = NDVI_CLOUD, k: int = K) -> DataFrame:
    """NIR sketches of the class-clear pixels of each scene, low NDVI apart: what is stored and merged."""
    clear = px.where(class_clear(F.col("scl"), exclude_water)).withColumn("low", F.coalesce(F.col("ndvi") < ndvi_cloud, F.lit(False)))
    return sketch(clear, [*keys, "low"], "b8a", k)


def sketched_thresholds(sketches: DataFrame, keys=SCENE) -> DataFrame:
    """Bright and dark thresholds per scene from its sketches; the dark one leaves out bright low-NDVI readings."""
    keys = list(keys)
    both = lambda nodes: nodes.groupBy(*keys, "level", "node").agg(F.sum("n").alias("n"))
    bright = quantile(both(sketches), keys, {"bright": CLOUD_QUANTILE})
    lower = F.expr("shiftleft(node, level)")
    left = sketches.join(bright, keys).where(~(F.col("low") & (lower > F.col("bright") * TOP)))
    return bright.join(quantile(both(left), keys, {"dark": SHADOW_QUANTILE}), keys, "left")
