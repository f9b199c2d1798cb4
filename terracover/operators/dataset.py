"""Training tables: labels joined to features, zone consolidation, statistics, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracover.functions.grades import training_balance
from terracover.functions.grid import clamp_index
from terracover.operators.joins import large_join, lookup_join
from terracover.sources.staging import stage

CELL = ("zone", "r", "c")


def join_labels(
    features: DataFrame, labels: DataFrame, extent: DataFrame | None = None,
    mode: str = "drop", exclude_ignored: bool = True,
) -> DataFrame:
    """Features with the label of their cell.

    ``drop`` treats pixels outside the label grid as ignored. ``clamp`` looks them up on
    the nearest border cell, which needs ``extent`` (zone, height, width) as a stored
    table.
    """
    if mode == "clamp":
        at = lookup_join(features, extent, "zone").withColumns(
            {"lr": clamp_index(F.col("r"), F.col("height")), "lc": clamp_index(F.col("c"), F.col("width"))}
        ).drop("height", "width")
        grid = labels.select("zone", F.col("r").alias("lr"), F.col("c").alias("lc"), "label")
        joined = large_join(at, grid, ["zone", "lr", "lc"], "left").drop("lr", "lc")
    elif mode == "drop":
        joined = large_join(features, labels.select(*CELL, "label"), [*CELL], "left")
    else:
        raise ValueError(f"unknown label mode: {mode}")
    joined = joined.withColumn("label", F.coalesce("label", F.lit(-1)).cast("smallint"))
    return joined.where("label <> -1") if exclude_ignored else joined


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and percentage per label; the window spans one row per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100)


def _class_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("label") == 1).alias("n_forest"),
        F.count_if(F.col("label") == 0).alias("n_nonforest"),
    ]


def class_balance(training: DataFrame, *keys: str) -> DataFrame:
    """Class totals, their ratio (NULL when a class is empty) and the balance grade."""
    pos, neg = F.col("n_forest"), F.col("n_nonforest")
    return (
        training.groupBy(*keys).agg(*_class_counts())
        .withColumn("ratio", F.when((pos > 0) & (neg > 0), neg / F.nullif(pos, F.lit(0))))
        .withColumn("balance", training_balance(pos, neg))
    )


def zone_stats(training: DataFrame) -> DataFrame:
    """Per-zone and overall (``zone`` NULL) class statistics; ratio is 0 without forest."""
    pos, neg, total = F.col("n_forest"), F.col("n_nonforest"), F.col("n_total")
    return (
        training.rollup("zone").agg(*_class_counts(), F.grouping("zone").cast("int").alias("is_total"))
        .withColumn("ratio", F.when(pos > 0, neg / F.nullif(pos, F.lit(0))).otherwise(F.lit(0.0)))
        .withColumn("pct_forest", F.when(total > 0, pos / total * 100).otherwise(F.lit(0.0)))
    )


def consolidate(tables: dict[str, DataFrame]) -> DataFrame:
    """Per-zone tables as one table with a ``zone`` column, types widened as needed."""
    if not tables:
        raise ValueError("no zone table could be read")
    tagged = [df.withColumn("zone", F.lit(zone)) for zone, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def zone_subset(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """Keep or leave out zones; prunes partitions of a table written by zone."""
    if include is not None:
        df = df.where(F.col("zone").isin(list(include)))
    if exclude is not None:
        df = df.where(~F.col("zone").isin(list(exclude)))
    return df


def enough_per_class(training: DataFrame, min_samples: int = 1000) -> DataFrame:
    """Rows of classes with enough samples."""
    classes = training.groupBy("label").count().where(F.col("count") >= min_samples).select("label")
    return lookup_join(training, stage(classes, "classes"), "label", "left_semi")


def empty_zones(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Expected zones without a single output row."""
    return expected.select("zone").distinct().join(
        produced.select("zone").distinct(), "zone", "left_anti"
    )


# Columns that are never features.
NON_FEATURES = frozenset(
    {"label", "x", "y", "date", "year", "finca_id", "zone", "zone_name"}
    | {"r", "c", "split", "class_weight", "ts", "scene"}
)


def feature_columns(df: DataFrame, label: str = "label", exclude=NON_FEATURES) -> list[str]:
    """Numeric columns of any width except label, keys and bookkeeping columns."""
    skip = set(exclude) | {label}
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def clean_features(df: DataFrame, columns) -> DataFrame:
    """Infinite, NaN and NULL values of the given columns become 0."""
    def clean(name: str) -> Column:
        value = F.col(name).cast("double")
        odd = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
        return F.when(odd, F.lit(0.0)).otherwise(value)

    return df.withColumns({name: clean(name) for name in columns})


def complete_rows(df: DataFrame, columns) -> DataFrame:
    """Rows without NULL or NaN in the given columns (what the assembler keeps)."""
    keep = F.lit(True)
    for name in columns:
        value = F.col(name).cast("double")
        keep = keep & value.isNotNull() & ~F.isnan(value)
    return df.where(keep)


def dataset_checks(training: DataFrame, columns, split: str = "split", min_rows: int = 5000,
                   max_ratio: float = 5.0, max_drift: float = 0.05) -> DataFrame:
    """One row of dataset assertions and the numbers behind them, in one aggregation."""
    bad = F.lit(False)
    for name in columns:
        value = F.col(name).cast("double")
        bad = bad | value.isNull() | F.isnan(value)
    share = lambda part: F.avg(F.when(F.col(split) == part, (F.col("label") == 1).cast("double")))
    pos, neg = F.col("n_forest"), F.col("n_nonforest")
    return (
        training.agg(
            *_class_counts(),
            F.count_if(bad).alias("n_incomplete"),
            F.count_if(~F.coalesce(F.col("label").isin(0, 1), F.lit(False))).alias("n_not_binary"),
            share("train").alias("share_train"),
            share("test").alias("share_test"),
        )
        .select(
            "n_total",
            "n_incomplete",
            "n_not_binary",
            (F.col("n_total") > min_rows).alias("enough_rows"),
            F.coalesce(
                F.greatest(pos, neg) / F.nullif(F.least(pos, neg), F.lit(0)) < max_ratio, F.lit(False)
            ).alias("balanced"),
            (F.col("n_incomplete") == 0).alias("complete"),
            (F.col("n_not_binary") == 0).alias("binary_labels"),
            F.coalesce(F.abs(F.col("share_train") - F.col("share_test")) < max_drift, F.lit(False)).alias(
                "similar_split"
            ),
        )
    )
