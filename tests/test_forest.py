"""Forests grown from counts against Spark ML's trainer and plain Python."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from terracover.operators import forest, models
from terracover.plans import jobs
from terracover.sources import sinks

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    made = []
    for i in range(3000):
        a, b, c = rng.random(), float(rng.randrange(5)), rng.gauss(0, 1)
        made.append((i % 2, i, 0, a, b, c, int(a + 0.2 * b + 0.1 * c > 0.9) if rng.random() < 0.95 else 0, 1.0 + (i % 3 if i % 2 else 0.5)))
    made += [(0, 5000, 0, None, 1.0, 1.0, 1, 1.0), (0, 5001, 0, float("nan"), 1.0, 1.0, 0, 1.0)]
    df = spark.createDataFrame(made, "zone int, r int, c0 int, a double, b double, c double, label int, class_weight double")
    return df.repartition(3, "zone", "r").sortWithinPartitions("zone", "r").persist()


def grown(rows, features=FEATURES, **params):
    return PipelineModel([models.pipeline(features, None).getStages()[0], forest.grow(rows, features, models.classifier("RandomForest", **params))])


def test_forests_are_as_good_as_those_of_the_library(rows):
    params = {"numTrees": 30, "maxDepth": 6, "maxBins": 32, "minInstancesPerNode": 3}
    ours, theirs = grown(rows, **params), models.pipeline(FEATURES, models.classifier("RandomForest", **params)).fit(rows)
    accuracy = lambda m: models.score(m, rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert accuracy(ours) == pytest.approx(accuracy(theirs), abs=0.01)
    assert models.importances(ours).count() == 3
    a, b = (m.stages[-1].featureImportances.toArray() for m in (ours, theirs))
    assert np.abs(a - b).max() < 0.05
    assert ours.stages[-1].getNumTrees == 30 and ours.stages[-1].getOrDefault("maxDepth") == 6 and ours.stages[-1].numClasses == 2


@pytest.mark.parametrize("same_weights", [True, False])
def test_every_node_holds_the_rows_that_reach_it(spark, rows, tmp_path, same_weights):
    """Rows of each tree's bag, followed by hand through the stored splits, give the stored class weights and best gains."""
    used = rows.withColumn("class_weight", F.when(F.col("label") == 1, 2.5).otherwise(0.5)) if same_weights else rows
    trees, depth, n_bins, seed = 4, 4, 16, 42
    model = grown(used, numTrees=trees, maxDepth=depth, maxBins=n_bins, minInstancesPerNode=2, featureSubsetStrategy="all")
    model.stages[-1].save(f"{tmp_path}/m")
    nodes = {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in spark.read.parquet(f"{tmp_path}/m/data").collect()}
    parts = {}
    complete = used.where("a IS NOT NULL AND NOT isnan(a)")
    for x in complete.withColumn("part", F.spark_partition_id()).collect():
        parts.setdefault(x["part"], []).append(x)
    table = forest.bag_table(1.0)
    cuts = forest.thresholds(complete, FEATURES, n_bins)
    assert all((np.diff(c) > 0).all() and len(c) < n_bins for c in cuts) and list(cuts[1]) == [0.5, 1.5, 2.5, 3.5]

    def impurity(w):
        return 1 - sum((x / sum(w)) ** 2 for x in w) if sum(w) else 0.0

    for tree in range(trees):
        bag = []
        for part, held in parts.items():
            times = table[np.random.default_rng([seed, 2, tree, part, 0]).integers(0, 1 << 16, len(held), dtype=np.uint16)]
            bag += [(x, int(t)) for x, t in zip(held, times) if t]
        reach = {0: bag}
        for at in sorted(n for t, n in nodes if t == tree):
            here, node = reach[at], nodes[tree, at]
            weights = [sum(t * x["class_weight"] for x, t in here if x["label"] == k) for k in (0, 1)]
            assert node["impurityStats"] == pytest.approx(weights, abs=1e-6) and node["rawCount"] == sum(t for _, t in here)
            if node["leftChild"] < 0:
                continue
            best = -1.0
            for f, values in zip(FEATURES, cuts):
                for v in values:
                    left, right = ([(x, t) for x, t in here if (x[f] <= v) == side] for side in (True, False))
                    if min(sum(t for _, t in s) for s in (left, right)) < 2:
                        continue
                    sides = [[sum(t * x["class_weight"] for x, t in s if x["label"] == k) for k in (0, 1)] for s in (left, right)]
                    best = max(best, impurity(weights) - sum(sum(w) * impurity(w) for w in sides) / sum(weights))
            assert node["gain"] == pytest.approx(best, abs=1e-9)
            f, v = FEATURES[node["split"]["featureIndex"]], node["split"]["leftCategoriesOrThreshold"][0]
            reach[node["leftChild"]] = [(x, t) for x, t in here if x[f] <= v]
            reach[node["rightChild"]] = [(x, t) for x, t in here if x[f] > v]


def test_forests_repeat_and_survive_storage(spark, rows, tmp_path):
    params = {"numTrees": 6, "maxDepth": 5}
    first, again = (grown(rows, **params) for _ in range(2))
    assert first.stages[-1].toDebugString.split("\n", 1)[1] == again.stages[-1].toDebugString.split("\n", 1)[1]
    sinks.save_model(first, f"{tmp_path}/m")
    scores = lambda m: {tuple(r) for r in models.score(m, rows).select("r", "score").collect()}
    assert scores(sinks.load_model(f"{tmp_path}/m")) == scores(first)


def test_small_blocks_and_odd_tables(spark, rows):
    small = forest.grow(rows, FEATURES, models.classifier("RandomForest", numTrees=3, maxDepth=3), block_rows=100)
    assert small.totalNumNodes > 6
    settled = rows.where("label = 0")  # one class: a tree is its root
    assert forest.grow(settled, FEATURES, models.classifier("RandomForest", numTrees=2)).totalNumNodes == 2
    constant = rows.withColumn("a", F.lit(1.0))
    assert forest.grow(constant, ["a"], models.classifier("RandomForest", numTrees=2)).totalNumNodes == 2
    for bad in (rows.where("false"), rows.withColumn("label", F.lit(None).cast("int")), rows.withColumn("class_weight", F.lit(None).cast("double"))):
        assert forest.grow(bad, FEATURES, models.classifier("RandomForest", numTrees=2)) is None
    assert forest.grow(rows, FEATURES, models.classifier("RandomForest", numTrees=2, maxDepth=18)) is None


def test_large_fits_are_grown_from_counts(spark, rows, monkeypatch):
    made, grow = [], forest.grow
    monkeypatch.setattr(forest, "grow", lambda *a, **k: made.append(1) or grow(*a, **k))
    models.refit(rows.withColumnRenamed("c0", "col"), FEATURES, "RandomForest", {"numTrees": 3, "maxDepth": 2})
    assert not made
    monkeypatch.setattr(models, "FIT_ROWS", 1000)
    model = models.refit(rows.withColumnRenamed("c0", "col"), FEATURES, "RandomForest", {"numTrees": 3, "maxDepth": 2})
    assert made and model.stages[-1].getNumTrees == 3


def test_a_search_fits_each_point_once(spark, rows, monkeypatch):
    """Of three features both names take two; the search's last fit is the model."""
    fits, fit = [], models.fit
    monkeypatch.setattr(models, "fit", lambda *a: fits.append(1) or fit(*a))
    grid = {"numTrees": [2], "maxDepth": [2], "featureSubsetStrategy": ["sqrt", "log2", "all"]}
    table = rows.drop("class_weight").withColumnRenamed("c0", "col")
    _, params, _ = models.tune(rows, FEATURES, "RandomForest", grid, method="folds", folds=2, keys=("zone", "r"))
    assert len(fits) == 2 * 2 + 1
    fits.clear()
    result = jobs.train_models(table.select("zone", "r", "col", *FEATURES, "label"), ("zone", "r"), {"GBT": {"maxIter": [2], "maxDepth": [2]}})
    assert len(fits) == 2 and result["winner"] == "GBT" and result["metrics"] == result["families"]["GBT"]["test"]
    with pytest.raises(ValueError):
        models.tune(rows.withColumn("f", F.lit(0)), FEATURES, "GBT", {"maxIter": [2]}, method="folds", folds=2, fold_col="f")


def test_searches_and_curves_grow_forests_side_by_side(spark, rows, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 500)
    table = rows.withColumnRenamed("c0", "c_").where("a IS NOT NULL AND NOT isnan(a)")
    _, params, score = models.tune(table, FEATURES, "RandomForest", {"numTrees": [3], "maxDepth": [3, 4]}, method="folds", folds=2, keys=("zone", "r"))
    assert params["maxDepth"] in (3, 4) and score > 0.8
    curve = models.learning_curve(table, table, FEATURES, ("zone", "r"), numTrees=3, maxDepth=3).collect()
    assert [r["fraction"] for r in curve] == [0.25, 0.5, 1.0] and all(r["accuracy"] > 0.8 for r in curve)
