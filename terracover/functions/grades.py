"""Grades and issue types as plain CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_balance(n_forest: Column, n_nonforest: Column) -> Column:
    """Class balance of a label grid; NULL when a class is empty."""
    return F.when((n_forest > 0) & (n_nonforest > 0), (
        F.when(n_nonforest / F.nullif(n_forest, F.lit(0)) > 10, "significant")
        .when(n_nonforest / F.nullif(n_forest, F.lit(0)) > 3, "moderate")
        .otherwise("reasonable")
    ))


def training_balance(n_forest: Column, n_nonforest: Column) -> Column:
    """Class balance of a training table; NULL when a class is empty."""
    ratio = n_nonforest / F.nullif(n_forest, F.lit(0))
    return F.when((n_forest > 0) & (n_nonforest > 0),
                  F.when((ratio > 10) | (ratio < 0.1), "significant").otherwise("reasonable"))


def issue_type(issues: Column) -> Column:
    """Name of a product's issue set (array of issue names); NULL for none.

    A single CRS or bounds issue keeps its name, a missing overlap always names the
    product, anything else is ``multiple_issues``.
    """
    return (
        F.when(F.size(issues) == 0, F.lit(None).cast("string"))
        .when(F.array_contains(issues, "no_overlap"), "no_overlap")
        .when((F.size(issues) == 1) & F.get(issues, F.lit(0)).isin("crs_mismatch", "bounds_invalid"),
              F.get(issues, F.lit(0)))
        .otherwise("multiple_issues")
    )


def auc_grade(auc: Column) -> Column:
    return F.when(auc > 0.9, "excellent").when(auc > 0.8, "good").otherwise("moderate")


def recall_grade(recall: Column) -> Column:
    return F.when(recall > 0.8, "good").otherwise("needs_improvement")


def recommendations(recall: Column, auc: Column, fp: Column, tp: Column) -> Column:
    """Names of the recommendations that apply, in report order."""
    return F.array_compact(
        F.array(
            F.when(recall < 0.7, "low_recall"),
            F.when(auc > 0.9, "ready_for_production"),
            F.when(fp > tp * 2, "many_false_positives"),
        )
    )
