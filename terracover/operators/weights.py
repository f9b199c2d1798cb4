"""Balanced class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``total / (n_classes * count)`` per class; one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy()  # one row per class
    n_all, n_classes = F.sum("n").over(classes), F.count(F.lit(1)).over(classes)
    return counts.withColumn("weight", n_all / (n_classes * F.col("n")))


def add_class_weight(
    df: DataFrame, label: str = "label", fit_on: DataFrame | None = None, name: str = "class_weight"
) -> DataFrame:
    """Weight column from the class shares of ``fit_on`` (default ``df``); 1.0 if unseen.

    The weights are read as scalars (one row per class) and inlined as a CASE.
    """
    rows = class_weights(df if fit_on is None else fit_on, label).where(F.col(label).isNotNull()).collect()
    weight = F.lit(1.0)
    for row in rows:
        weight = F.when(F.col(label) == row[label], F.lit(row["weight"])).otherwise(weight)
    return df.withColumn(name, weight)
