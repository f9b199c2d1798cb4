"""Tree-ensemble training, tuning, selection and scoring with Spark ML."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracover.functions.hashing import key_digest, unit_interval
from terracover.operators import forest
from terracover.operators.metrics import evaluation

# Tuning grids.
RF_GRID = {
    "numTrees": [200, 400, 600],
    "maxDepth": [10, 14, 18],
    "maxBins": [64, 128],
    "featureSubsetStrategy": ["sqrt", "log2"],
}
GBT_GRID = {
    "maxDepth": [6, 8, 10],
    "maxBins": [64, 128],
    "maxIter": [100, 200],
    "stepSize": [0.05, 0.1, 0.2],
}
# The fixed forest. Spark ML has no minimum split size; the leaf size stands.
RF_FIXED = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 5}

# How trees are grown, not what is grown: node statistics per pass, and cached node ids where
# many trees pass the rows together; a single tree finds its nodes faster than they are kept.
EXECUTION = {
    "RandomForest": {"maxMemoryInMB": 1024, "cacheNodeIds": True},
    "GBT": {"maxMemoryInMB": 1024, "cacheNodeIds": False},
}

# A row's key. Partitions of a fit follow the counted rows alone, so that trees see rows in the
# same order everywhere. Every task sends the counts of all nodes, so a few tasks with many rows
# each are faster than many; beyond 8 of them tasks grow in number.
KEYS, FIT_ROWS, FIT_TASKS, MOST_FIT_ROWS = ("zone", "r", "c"), 1 << 13, 8, 1 << 19

FAMILIES = {"RandomForest": RandomForestClassifier, "GBT": GBTClassifier}


def classifier(family: str, label: str = "label", weight: str | None = "class_weight", seed: int = 42, **params):
    settings = {**EXECUTION[family], **params}
    estimator = FAMILIES[family](labelCol=label, featuresCol="features", seed=seed, **settings)
    return estimator.setWeightCol(weight) if weight else estimator


def pipeline(features, estimator) -> Pipeline:
    """Assembler that skips rows with NULL or NaN features, then the estimator."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[assembler, estimator])


def param_grid(estimator, grid: dict) -> list:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def in_order(rows: DataFrame, keys=KEYS) -> tuple[DataFrame, int]:
    """Rows dealt by key and sorted, so a fit does not depend on the file layout, and their number (0 without keys)."""
    keys = [k for k in keys if k in rows.columns]
    if not keys:
        return rows, 0
    n_rows = rows.count()
    return rows.repartition(fit_partitions(n_rows), *keys).sortWithinPartitions(*keys), n_rows


def fit(rows: DataFrame, features, estimator, n_rows: int) -> PipelineModel:
    """Fit on rows in order; forests of more than ``FIT_ROWS`` rows are grown by ``forest.grow``."""
    whole = pipeline(features, estimator)
    if n_rows > FIT_ROWS and isinstance(estimator, RandomForestClassifier):
        grown = forest.grow(rows, features, estimator)
        if grown is not None:
            return PipelineModel([whole.getStages()[0], grown])
    return whole.fit(rows)


def distinct_points(maps, n_features: int) -> list[int]:
    """Per point of a grid the first that gives the same fit: names of feature subsets may stand for one size."""
    first: dict = {}
    size = lambda v: forest.subset_size(v, n_features) or v
    resolved = [frozenset((p.name, size(v) if p.name == "featureSubsetStrategy" else v) for p, v in m.items()) for m in maps]
    return [first.setdefault(point, i) for i, point in enumerate(resolved)]


def fit_partitions(n_rows: int) -> int:
    """Partitions of a fit: ``FIT_ROWS`` rows each up to ``FIT_TASKS``, at most ``MOST_FIT_ROWS`` each beyond."""
    return max(1, min(FIT_TASKS, -(-n_rows // FIT_ROWS)), -(-n_rows // MOST_FIT_ROWS))


def fold_of(folds: int, seed: int, keys=KEYS):
    """Fold number from the hash of a row's key."""
    return F.floor(unit_interval(key_digest(seed + 2, *keys)) * folds).cast("int")


def tune(train: DataFrame, features, family: str, grid: dict, metric: str = "areaUnderPR",
         method: str = "split", folds: int = 5, parallelism: int = 8, seed: int = 42, keys=KEYS,
         fold_col: str | None = None, **params):
    """Grid search inside the training rows; returns (best model, best params, best metric).

    ``split`` holds out the first hash fold, ``folds`` each in turn; either way a row's part
    depends on its key alone. ``fold_col`` names a column of folds 0, 1, ... to use instead,
    such as the spatial ones of ``splits.grouped_folds``.
    """
    if method not in ("split", "folds"):
        raise ValueError(f"unknown tuning method: {method}")
    features = list(features)
    estimator = classifier(family, seed=seed, **params)
    maps = param_grid(estimator, grid)
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName=metric
    )
    part = F.col(fold_col).cast("int") if fold_col else fold_of(folds, seed, keys)
    ordered, n_rows = in_order(train, keys)
    rows = ordered.withColumn("fold", part).persist()
    try:
        if method == "folds":
            found = {r["fold"] for r in rows.select("fold").distinct().collect()}
            if found != set(range(folds)):
                raise ValueError(f"folds must be 0 to {folds - 1} and none empty: {sorted(map(str, found))}")
        same = distinct_points(maps, len(features))
        held = [0] if method == "split" else range(folds)

        def measure(task):
            i, k = task
            model = fit(rows.where(F.col("fold") != k), features, estimator.copy(maps[i]), n_rows)
            return evaluator.evaluate(model.transform(rows.where(F.col("fold") == k)))

        tasks = [(i, k) for i in sorted(set(same)) for k in held]
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            measured = dict(zip(tasks, pool.map(measure, tasks)))
        scores = [sum(measured[i, k] for k in held) / len(held) for i in same]
        best = max(range(len(maps)), key=scores.__getitem__)
        model = fit(rows, features, estimator.copy(maps[best]), n_rows)
    finally:
        rows.unpersist()
    return model, {p.name: v for p, v in maps[best].items()}, scores[best]


def refit(train: DataFrame, features, family: str, best_params: dict, seed: int = 42, keys=KEYS, **params) -> PipelineModel:
    """Fit the family again on all training rows with the tuned parameters set."""
    rows, n_rows = in_order(train, keys)
    return fit(rows, features, classifier(family, seed=seed, **{**params, **best_params}), n_rows)


def choose(scores: dict[str, float]) -> str:
    """Family with the highest validation metric; GBT wins ties."""
    return max(scores, key=lambda name: (scores[name], name == "GBT"))


def choices(table: DataFrame, keys, family: str = "family", metric: str = "metric") -> DataFrame:
    """:func:`choose` for every run of a table (keys, family, metric): ``winner`` and its metric."""
    best = F.max(F.struct(F.col(metric).alias("metric"), (F.col(family) == "GBT").alias("boosted"), F.col(family).alias("family")))
    return table.groupBy(*keys).agg(best.alias("best")).select(*keys, F.col("best.family").alias("winner"), F.col("best.metric").alias("metric"))


def score(model: PipelineModel, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Predictions with ``score``, the probability of class 1; optional own threshold."""
    scored = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    if threshold is not None:
        scored = scored.withColumn("prediction", (F.col("score") >= threshold).cast("double"))
    return scored.drop("features", "rawPrediction", "probability")


def mean_vote(scores, threshold: float = 0.5) -> dict:
    """Columns of the vote over score columns: their mean, missing ones left out, and the prediction."""
    given = [F.coalesce(F.col(c), F.lit(0.0)) for c in scores]
    counted = [F.col(c).isNotNull().cast("int") for c in scores]
    mean = reduce(lambda a, b: a + b, given) / F.nullif(reduce(lambda a, b: a + b, counted), F.lit(0))
    return {"score": mean, "prediction": (mean >= threshold).cast("double")}


def score_all(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``score``; rows with a missing feature stay, with a NULL score."""
    inputs = model.stages[0].getInputCols()
    complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in inputs))
    patient = model.stages[0].copy().setHandleInvalid("keep")
    scored = score(PipelineModel([patient, *model.stages[1:]]), df)
    return scored.withColumn("score", F.when(complete, F.col("score"))).drop("prediction")


def vote(fitted, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Mean score of several models and the resulting prediction.

    The rows pass through one model after the other, so nothing is joined and none is lost;
    a row without any score has a NULL prediction.
    """
    names = [f"score_{i}" for i in range(len(fitted))]
    for name, model in zip(names, fitted):
        df = score_all(model, df).withColumnRenamed("score", name)
    return df.withColumns(mean_vote(names, threshold)).drop(*names)


def importances(model: PipelineModel) -> DataFrame:
    """Feature importances, named by the assembler's own inputs."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray().tolist()
    return SparkSession.getActiveSession().createDataFrame(
        list(zip(names, values)), "feature string, importance double"
    )


def top_features(table: DataFrame, k: int = 10) -> DataFrame:
    return table.orderBy(F.col("importance").desc(), "feature").limit(k)


def learning_curve(train: DataFrame, test: DataFrame, features, keys, fractions=(0.25, 0.5, 1.0),
                   family: str = "RandomForest", seed: int = 42, **params) -> DataFrame:
    """Test metrics of fits on nested hash fractions of the training rows."""
    u = unit_interval(key_digest(seed + 1, *keys))

    def point(fraction: float) -> DataFrame:
        model = refit(train.where(u < fraction), features, family, params, seed=seed)
        return evaluation(score(model, test)).select(
            F.lit(float(fraction)).alias("fraction"), "roc_auc", "average_precision", "accuracy"
        )

    # The largest first: the others run beside it.
    largest_first = sorted(fractions, reverse=True)
    with ThreadPool(len(largest_first)) as pool:
        curves = dict(zip(largest_first, pool.map(point, largest_first, chunksize=1)))
    return reduce(DataFrame.unionByName, (curves[f] for f in fractions))
