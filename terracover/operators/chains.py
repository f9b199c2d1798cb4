"""Pointer doubling over rows that name their successor: cycles and places on them.

Every round a row takes over what its successor knows and points twice as far, so a cycle of
``n`` rows takes about ``log2 n`` rounds of one join by id, whatever its shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.operators.joins import large_join
from terracover.sources.staging import stage


def cycle_heads(links: DataFrame) -> DataFrame:
    """(id, next, head): ``links`` (id, next, mark) whose every row is on a cycle; ``head`` is its least mark.

    When a round lowers no mark, steps of twice its length lower none either, so every row
    knows the least one of its cycle.
    """
    table = stage(links.select("id", F.col("next").alias("far"), F.col("mark").alias("head")), "cycles")
    while True:
        ahead = table.select(F.col("id").alias("at"), F.col("far").alias("farther"), F.col("head").alias("theirs"))
        lower = F.col("theirs") < F.col("head")
        table = stage(large_join(table, ahead, F.col("far") == F.col("at")).select(
            "id", F.col("farther").alias("far"), F.when(lower, F.col("theirs")).otherwise(F.col("head")).alias("head"), lower.alias("moved"),
        ), "cycles")
        if table.where("moved").isEmpty():
            return large_join(links.select("id", "next", "mark"), table.select("id", "head"), "id")
        table = table.drop("moved")


def cycle_places(rows: DataFrame) -> DataFrame:
    """(id, head, place): rows of :func:`cycle_heads` numbered along their cycle from the head."""
    first = F.col("mark") == F.col("head")
    table = stage(rows.select(
        "id", "head", F.when(first, F.col("id")).otherwise(F.col("next")).alias("far"), F.when(first, 0).otherwise(1).cast("long").alias("steps"),
    ), "places")
    heads = rows.where(first).select(F.col("id").alias("end"))
    while True:
        ahead = table.select(F.col("id").alias("at"), F.col("far").alias("farther"), F.col("steps").alias("more"))
        table = stage(large_join(table, ahead, F.col("far") == F.col("at")).select(
            "id", "head", F.col("farther").alias("far"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved"),
        ), "places")
        if table.where("moved").isEmpty():
            break
        table = table.drop("moved")
    sizes = stage(table.groupBy("far").agg(F.count(F.lit(1)).alias("size")), "sizes")
    met = large_join(table.select("id", "head", "far", "steps"), sizes.join(heads, F.col("far") == F.col("end")).select("far", "size"), "far")
    return met.select("id", "head", F.when(F.col("steps") == 0, 0).otherwise(F.col("size") - F.col("steps")).alias("place"))
