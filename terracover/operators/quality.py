"""Product quarantine and run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.functions.grades import issue_type
from terracover.functions.grid import bounds_check, tile_epsg

# Issue names counted in the summary and run states.
ISSUES = ("crs_mismatch", "bounds_invalid", "no_overlap", "multiple_issues")
RUN_STATES = ("success", "error", "timeout", "exception")


def product_issues(products: DataFrame) -> DataFrame:
    """Issue list and type per product; both empty for a sound product.

    ``products``: product, file_crs, left, bottom, right, top, n_overlap, clip_failed.
    """
    expected = F.coalesce(tile_epsg(F.col("product")), "file_crs")
    bounds = bounds_check(*(F.col(c) for c in ("left", "bottom", "right", "top")))
    return (
        products.withColumns({"expected_crs": expected, "bounds": bounds})
        .withColumn(
            "issues",
            F.array_compact(
                F.array(
                    F.when(F.col("file_crs") != F.col("expected_crs"), "crs_mismatch"),
                    F.when(~F.col("bounds.valid"), "bounds_invalid"),
                    F.when(F.col("n_overlap") == 0, "no_overlap"),
                    F.when(F.col("clip_failed"), "clip_error"),
                )
            ),
        )
        .withColumn("issue_type", issue_type(F.col("issues")))
    )


def quarantine(products: DataFrame) -> DataFrame:
    """Log entry of every product with an issue; details are a JSON document."""
    checked = product_issues(products).where(F.size("issues") > 0)
    has = lambda name: F.array_contains("issues", name)
    details = F.to_json(
        F.struct(
            F.when(has("crs_mismatch"), F.struct("file_crs", "expected_crs")).alias("crs_mismatch"),
            F.when(has("bounds_invalid"), F.struct("bounds.lat_valid", "bounds.lon_valid")).alias("bounds_invalid"),
            F.when(has("no_overlap"), F.struct("n_overlap")).alias("no_overlap"),
            F.when(has("clip_error"), F.struct("clip_failed")).alias("clip_error"),
        )
    )
    return checked.select(
        "zone", "product", "issue_type", F.concat_ws(",", "issues").alias("issues"), details.alias("details")
    )


def clean_products(products: DataFrame, keep_if=()) -> DataFrame:
    """Products without issues; ``keep_if`` names issues that are tolerated."""
    tolerated = F.array(*map(F.lit, keep_if)).cast("array<string>")
    left = F.size(F.array_except("issues", tolerated))
    return product_issues(products).where(left == 0).select(*products.columns)


def quarantine_summary(log: DataFrame) -> DataFrame:
    """Quarantined products per zone and issue type."""
    return log.groupBy("zone").agg(
        F.count(F.lit(1)).alias("n_quarantined"),
        *(F.count_if(F.col("issue_type") == name).alias(name) for name in ISSUES),
    )


def zone_run(expected: DataFrame, steps: dict[str, DataFrame]) -> DataFrame:
    """One row per expected zone: rows after each step, status and the first step that left none.

    ``steps`` maps step names in order to tables with a ``zone`` column; a zone counts as
    stopped at its first empty step, whatever later steps hold. All zones run in one job,
    so there is no time per zone: ``duration`` is NULL. The result is a log that
    :func:`run_report` reads.
    """
    zones, names = expected.select("zone").distinct(), list(steps)
    for i, name in enumerate(names):
        counts = steps[name].groupBy("zone").agg(F.count(F.lit(1)).alias(f"n_{i}"))
        zones = zones.join(counts, "zone", "left")
    counted = [F.coalesce(f"n_{i}", F.lit(0)).cast("bigint") for i in range(len(names))]
    failed = F.coalesce(*(F.when(n == 0, name) for n, name in zip(counted, names)))
    return zones.select(
        "zone", F.when(failed.isNull(), "success").otherwise("error").alias("status"), failed.alias("failed_step"),
        F.lit(None).cast("double").alias("duration"), *(n.alias(f"n_{name[3:]}") for n, name in zip(counted, names)),
    )


def run_report(log: DataFrame) -> DataFrame:
    """Run counts by state, durations and the earliest failing step.

    One row per zone and an overall row with ``zone`` NULL.
    """
    return log.rollup("zone").agg(
        F.count(F.lit(1)).alias("n_runs"),
        *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in RUN_STATES),
        F.sum("duration").alias("total_duration"),
        F.min("failed_step").alias("first_failed_step"),
    )
