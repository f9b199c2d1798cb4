"""Binary classification metrics from a table of labels, predictions and scores.

Threshold metrics work on counts per distinct score with running totals, so neither a
frequent score nor a very large table ends up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracover.functions.grades import auc_grade, recall_grade, recommendations
from terracover.operators.ranking import GROUP_LIMIT, running_totals
from terracover.sources.staging import stage


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, 0 for a zero denominator."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / F.nullif(den, F.lit(0)))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with tn, fp, fn, tp; missing cells are 0."""
    y, p = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _f1(precision: Column, recall: Column) -> Column:
    return ratio(F.lit(2.0) * precision * recall, precision + recall)


def _rates() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rates = {
        "accuracy": ratio(tp + tn, tn + fp + fn + tp),
        "precision_0": ratio(tn, tn + fn),
        "recall_0": ratio(tn, tn + fp),
        "precision_1": ratio(tp, tp + fp),
        "recall_1": ratio(tp, tp + fn),
    }
    rates["f1_0"] = _f1(rates["precision_0"], rates["recall_0"])
    rates["f1_1"] = _f1(rates["precision_1"], rates["recall_1"])
    return rates


def class_metrics(confusion: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each class; class 1 is the positive class."""
    rates = _rates()
    rows = F.array(
        *(
            F.struct(
                F.lit(k).alias("class"),
                *(rates[f"{m}_{k}"].alias(m) for m in ("precision", "recall", "f1")),
                (F.col("tn") + F.col("fp") if k == 0 else F.col("fn") + F.col("tp")).alias("support"),
            )
            for k in (0, 1)
        )
    )
    return confusion.select(F.explode(rows).alias("m")).select("m.*")


def weighted_metrics(confusion: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    rates = _rates()
    n0, n1 = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    weighted = lambda m: ratio(rates[f"{m}_0"] * n0 + rates[f"{m}_1"] * n1, n0 + n1)
    return confusion.select(
        rates["accuracy"].alias("accuracy"),
        *(weighted(m).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")),
    )


def _score_counts(df: DataFrame, label: str, *keys) -> DataFrame:
    """Positives ``pos`` and rows ``n`` per key for 0/1 labels."""
    return df.groupBy(*keys).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")
    )


def score_totals(
    df: DataFrame, label: str = "label", score: str = "score", limit: int = GROUP_LIMIT
) -> DataFrame:
    """Positives ``pos`` and rows ``n`` per score with totals from the highest score down."""
    counts = _score_counts(df, label, F.col(score).alias("score"))
    return running_totals(counts, [], "score", ["pos", "n"], descending=True, limit=limit)


def threshold_areas(totals: DataFrame) -> DataFrame:
    """ROC AUC, average precision (steps) and trapezoid PR area from ``score_totals``."""
    pos, n, tp, seen = (F.col(c) for c in ("pos", "n", "cum_pos", "cum_n"))
    p_all, n_all = F.col("total_pos"), F.col("total_n")
    neg = n - pos
    neg_below = (n_all - p_all) - (seen - tp)
    precision = tp / seen
    precision_before = F.when(seen > n, (tp - pos) / F.nullif(seen - n, F.lit(0))).otherwise(precision)
    sums = totals.agg(
        F.sum(pos * neg_below + F.lit(0.5) * pos * neg).alias("wins"),
        F.sum(precision * pos).alias("steps"),
        F.sum((precision + precision_before) / 2 * pos).alias("trapezoids"),
        F.max(p_all).alias("p_all"),
        F.max(n_all).alias("n_all"),
    )
    p, negatives = F.col("p_all"), F.col("n_all") - F.col("p_all")
    return sums.select(
        ratio(F.col("wins"), p * negatives).alias("roc_auc"),
        ratio(F.col("steps"), p).alias("average_precision"),
        ratio(F.col("trapezoids"), p).alias("area_under_pr"),
    )


def roc_points(totals: DataFrame) -> DataFrame:
    """False and true positive rate when every score at or above the row's is positive."""
    return totals.select(
        "score",
        ratio(F.col("cum_n") - F.col("cum_pos"), F.col("total_n") - F.col("total_pos")).alias("fpr"),
        ratio(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
    )


def pr_points(totals: DataFrame) -> DataFrame:
    """Precision and recall when every score at or above the row's is positive."""
    return totals.select(
        "score",
        ratio(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
        ratio(F.col("cum_pos"), F.col("total_pos")).alias("recall"),
    )


def threshold_sweep(
    df: DataFrame, thresholds, label: str = "label", score: str = "score"
) -> DataFrame:
    """Confusion counts, precision, recall and F1 at each threshold (``score >= t``).

    Rows are counted once by the number of thresholds they reach, so everything after the
    first aggregation has at most one row per threshold.
    """
    thresholds = sorted(float(t) for t in thresholds)
    reached = sum(((F.col(score) >= t).cast("int") for t in thresholds), F.lit(0))
    per_step = df.groupBy(reached.alias("reached")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    # Step 0 collects all rows, step k those reaching the k-th threshold.
    selected = (
        per_step.select(F.explode(F.sequence(F.lit(0), "reached")).alias("step"), "pos", "n")
        .groupBy("step").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    )
    steps = df.sparkSession.createDataFrame(
        [(0, None), *enumerate(thresholds, 1)], "step int, threshold double"
    )
    whole = lambda name: F.max(F.when(F.col("step") == 0, F.col(name))).over(Window.partitionBy())
    rates = _rates()
    return (
        steps.join(selected, "step", "left").na.fill(0, ["pos", "n"])
        .withColumns({"p_all": whole("pos"), "n_all": whole("n")})
        .where("step > 0")
        .select(
            "threshold",
            (F.col("n_all") - F.col("p_all") - F.col("n") + F.col("pos")).alias("tn"),
            (F.col("n") - F.col("pos")).alias("fp"),
            (F.col("p_all") - F.col("pos")).alias("fn"),
            F.col("pos").alias("tp"),
        )
        .select(
            "*", rates["precision_1"].alias("precision"), rates["recall_1"].alias("recall"),
            rates["f1_1"].alias("f1"),
        )
    )


def evaluation(df: DataFrame, label: str = "label", prediction: str = "prediction",
               score: str = "score", limit: int = GROUP_LIMIT) -> DataFrame:
    """One row with every metric: threshold areas, confusion, per-class and weighted rates.

    ``df`` is read once, into counts per score and prediction, so an expensive scoring
    plan behind it runs once.
    """
    counts = stage(
        _score_counts(df, label, F.col(score).alias("score"), F.col(prediction).cast("int").alias("prediction")),
        "score_counts",
    )
    cell = lambda p, rows: F.coalesce(F.sum(F.when(F.col("prediction") == p, rows)), F.lit(0))
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    confusion = counts.agg(
        cell(0, neg).alias("tn"), cell(1, neg).alias("fp"), cell(0, pos).alias("fn"), cell(1, pos).alias("tp")
    )
    rates = _rates()
    n0, n1 = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    weighted = lambda m: ratio(rates[f"{m}_0"] * n0 + rates[f"{m}_1"] * n1, n0 + n1)
    flat = confusion.select(
        "*",
        *(value.alias(name) for name, value in rates.items()),
        *(weighted(m).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")),
        F.lit(1).alias("k"),
    )
    per_score = counts.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    totals = running_totals(per_score, [], "score", ["pos", "n"], descending=True, limit=limit)
    return flat.join(threshold_areas(totals).withColumn("k", F.lit(1)), "k").drop("k")


def metric_grades(metrics: DataFrame) -> DataFrame:
    """Grades and recommendations for a row of ``evaluation``."""
    auc, recall = F.col("roc_auc"), F.col("recall_1")
    return metrics.select(
        auc_grade(auc).alias("auc_grade"),
        recall_grade(recall).alias("recall_grade"),
        F.concat_ws(",", recommendations(recall, auc, F.col("fp"), F.col("tp"))).alias("recommendations"),
    )
