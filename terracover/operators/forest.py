"""Random forests of many rows, grown from counts per tree, node, feature and bin.

Spark ML's trainer looks up every row in every tree and keeps a bag count and a node number
for each pair. Here rows are binned once, to a byte per feature, and cached as blocks of
arrays; bag counts come from seeded generators and nodes from the splits found so far, so
nothing is kept per row and tree. Each level is one job: a task counts its blocks tree by
tree, counts of a tree's run of nodes meet in one group, and their best splits go to the
driver. Rules are those of Spark ML: Poisson bags, a feature subset per node, Gini gain,
splits half-way between quantiles, leaves of equal prediction merged. The result is an
ordinary ``RandomForestClassificationModel``.

Rows with a missing feature are skipped. Counts are whole numbers, so a forest depends on
the order of rows in their partitions and on the seed, not on the order in which tasks end.
"""

from __future__ import annotations

import json
import math
import sys
import time
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from terracover.sources.staging import staging_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a block; nodes whose counts meet in one group; probes per feature for its splits;
# depth up to which the driver holds trees as arrays with a place for every node.
BLOCK_ROWS, CHUNK_NODES, PROBES, MOST_DEPTH = 1 << 17, 128, 2048, 12
_BLOCK = "part int, block int, n int, bins binary, label binary, weight binary"
_COUNTS = "tree int, chunk int, part int, kind string, counts binary, weights binary"
_SPLITS = "tree int, chunk int, nodes binary"
SUBSETS = {
    "auto": lambda n: math.ceil(math.sqrt(n)), "sqrt": lambda n: math.ceil(math.sqrt(n)),
    "log2": lambda n: max(1, math.ceil(math.log2(n))), "onethird": lambda n: math.ceil(n / 3), "all": lambda n: n,
}


def subset_size(strategy: str, n_features: int) -> int | None:
    """Features a node of a forest looks at; None for strategies only Spark ML knows."""
    return SUBSETS[strategy](n_features) if strategy in SUBSETS else None


def settings(estimator, n_features: int) -> dict | None:
    """What :func:`grow` needs of an estimator, or None if it asks for something else."""
    given = {p.name: estimator.getOrDefault(p) for p in estimator.params if estimator.hasDefault(p) or estimator.isSet(p)}
    plain = given["numTrees"] > 1 and given["bootstrap"] and given["impurity"] == "gini" and given["minWeightFractionPerNode"] == 0
    given["subset"] = subset_size(given["featureSubsetStrategy"], n_features)
    return given if plain and given["subset"] and given["maxBins"] <= 256 and given["maxDepth"] <= MOST_DEPTH else None


# binning -----------------------------------------------------------------------------

def thresholds(rows: DataFrame, features, max_bins: int) -> list[np.ndarray]:
    """Ascending split values per feature: half-way between neighbouring values, or at even ranks if there are more."""
    probes = rows.approxQuantile(list(features), [i / PROBES for i in range(PROBES + 1)], 0.5 / PROBES)
    out = []
    for values in probes:
        known = np.unique(np.array(values, dtype=np.float64))
        cuts = np.arange(1, len(known))
        if len(cuts) > max_bins - 1:
            ranks = np.array(values)[[round(i * PROBES / max_bins) for i in range(1, max_bins)]]
            cuts = np.unique(np.clip(np.searchsorted(known, ranks, "right"), 1, len(known) - 1))
        out.append((known[cuts - 1] + known[cuts]) / 2)
    return out


def _to_blocks(cuts: list, block_rows: int):
    """Rows of (features..., label, weight) as blocks of bins."""
    def run(batches):
        from pyspark import TaskContext

        part, block, held, size = TaskContext.get().partitionId(), 0, [], 0

        def made(arrays):
            bins, label, weight = (np.concatenate(a) for a in zip(*arrays))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "n": pa.array([len(label)], pa.int32()),
                "bins": [bins.tobytes()], "label": [label.tobytes()], "weight": [weight.tobytes()],
            })

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            bins = np.stack([np.searchsorted(c, v, "left").astype(np.uint8) for c, v in zip(cuts, columns)], axis=1)
            arrays = bins, columns[-2].astype(np.uint8), columns[-1].astype(np.float64)
            while len(arrays[1]):
                taken = tuple(a[: block_rows - size] for a in arrays)
                arrays = tuple(a[block_rows - size:] for a in arrays)
                held.append(taken)
                size += len(taken[1])
                if size == block_rows:
                    yield made(held)
                    block, held, size = block + 1, [], 0
        if held:
            yield made(held)

    return run


# counting ----------------------------------------------------------------------------

def bag_table(rate: float) -> np.ndarray:
    """How often a row is drawn, by a uniform number of 16 bits: Poisson with mean ``rate``."""
    p, total, out = math.exp(-rate), 0.0, np.zeros(1 << 16, dtype=np.uint8)
    for k in range(255):
        total += p
        out[round(total * (1 << 16)):] = k + 1
        p *= rate / (k + 1)
    return out


def subsets(seed: int, tree: int, level: int, n_features: int, size: int) -> np.ndarray:
    """Features each node of a tree's level looks at, in rows of ``size``."""
    drawn = np.random.default_rng([seed, 1, tree, level]).random((1 << level, n_features))
    return np.sort(np.argsort(drawn, axis=1, kind="stable")[:, :size], axis=1)


def _count(level: int, spec: dict, state):
    """Counts per tree, run of nodes, subset feature, bin and class over a partition's blocks."""
    def run(batches):
        n_features, classes, n_bins, size, seed = (spec[k] for k in ("n_features", "classes", "n_bins", "subset", "seed"))
        feature, cut, slots = state.value
        blocks, part = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                blocks.append((row["block"], np.frombuffer(row["bins"], np.uint8), np.frombuffer(row["label"], np.uint8), np.frombuffer(row["weight"], np.float64)))
        if not blocks:
            return
        drawn = bag_table(spec["rate"])
        for tree in range(feature.shape[0]):
            slot = slots[tree]
            n_nodes = int(slot.max()) + 1
            if not n_nodes:
                continue
            looks = subsets(seed, tree, level, n_features, size)[slot >= 0]
            looks = [np.ascontiguousarray(looks[:, j]).astype(np.intp) for j in range(size)]
            counts = np.zeros((size, n_nodes * n_bins * classes))
            weights = np.zeros_like(counts) if spec["weighted"] else None
            splits, bounds = feature[tree].astype(np.intp), cut[tree]
            for block, bins, label, weight in blocks:
                bag = drawn[np.random.default_rng([seed, 2, tree, part, block]).integers(0, 1 << 16, len(label), dtype=np.uint16)]
                rows = np.flatnonzero(bag)
                at = rows * n_features
                node = np.ones(len(rows), dtype=np.intp)
                for _ in range(level):
                    right = bins[at + splits[node]] > bounds[node]
                    node = node * 2 + right
                place = slot[node - (1 << level)]
                if (place < 0).any():
                    kept = place >= 0
                    rows, at, place = rows[kept], at[kept], place[kept]
                if not len(rows):
                    continue
                times = bag[rows].astype(np.float64)
                base = place.astype(np.intp) * (n_bins * classes) + label[rows]
                for j in range(size):
                    index = base + bins[at + looks[j][place]].astype(np.intp) * classes
                    counts[j] += np.bincount(index, times, counts.shape[1])
                    if weights is not None:
                        weights[j] += np.bincount(index, times * weight[rows], counts.shape[1])
            # (node, subset feature, bin, class)
            shape = (size, n_nodes, n_bins * classes)
            counts = counts.reshape(shape).swapaxes(0, 1)
            kind = "u2" if counts.max() < 1 << 16 else "i8"
            counts = counts.astype(kind)
            weights = weights.reshape(shape).swapaxes(0, 1) if weights is not None else None
            for first in range(0, n_nodes, CHUNK_NODES):
                run_of = slice(first, first + CHUNK_NODES)
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([tree], pa.int32()), "chunk": pa.array([first // CHUNK_NODES], pa.int32()), "part": pa.array([part], pa.int32()),
                    "kind": [kind], "counts": [counts[run_of].tobytes()], "weights": pa.array([None if weights is None else weights[run_of].tobytes()], pa.binary()),
                })

    return run


def gini(w) -> np.ndarray:
    """Gini impurity of class weights along the last axis, 0 without any."""
    n = np.asarray(w.sum(-1))
    return 1 - np.divide((w * w).sum(-1), n * n, out=np.ones_like(n), where=n > 0)


def _best(level: int, spec: dict, state):
    """The best split of each node of a tree's run of nodes."""
    def run(key, table):
        n_features, classes, n_bins, size = (spec[k] for k in ("n_features", "classes", "n_bins", "subset"))
        tree, chunk = key[0].as_py(), key[1].as_py()
        slot = state.value[2][tree]
        positions = np.flatnonzero(slot >= 0)[chunk * CHUNK_NODES:(chunk + 1) * CHUNK_NODES]
        shape = (len(positions), size, n_bins, classes)
        order = np.argsort(table.column("part").to_numpy(), kind="stable")  # sums of doubles depend on it
        columns = [table.column(c) for c in ("kind", "counts", "weights")]
        counts, weights = np.zeros(shape), np.zeros(shape) if spec["weighted"] else None
        for i in order.tolist():
            kind, found, weighed = (c[i].as_py() for c in columns)
            counts += np.frombuffer(found, kind).reshape(shape)
            if weights is not None:
                weights += np.frombuffer(weighed).reshape(shape)
        if weights is None:
            weights = counts * np.array(spec["class_weights"])
        looks = subsets(spec["seed"], tree, level, n_features, size)[positions]
        left, raw_left = weights.cumsum(2), counts.cumsum(2).sum(3)
        total, raw = left[:, :1, -1:], raw_left[:, :1, -1:]
        right, raw_right = total - left, raw - raw_left
        n = total.sum(-1)
        gain = gini(total) - (left.sum(-1) * gini(left) + right.sum(-1) * gini(right)) / np.where(n > 0, n, 1)
        least = np.array(spec["splits"])[looks]  # splits of the feature looked at
        fits = (np.arange(n_bins) < least[:, :, None]) & (np.minimum(raw_left, raw_right) >= max(1, spec["least_rows"])) & (gain >= spec["least_gain"])
        flat = np.where(fits, gain, -1.0).reshape(len(positions), -1)
        best = flat.argmax(1)
        each = np.arange(len(positions))
        j, b = best // n_bins, best % n_bins
        found = np.concatenate([
            np.stack([positions, looks[each, j], b, flat[each, best], raw[:, 0, 0], raw_left[each, j, b]], axis=1), total[:, 0, 0], left[each, j, b],
        ], axis=1).astype(np.float64)
        return pa.table({"tree": pa.array([tree], pa.int32()), "chunk": pa.array([chunk], pa.int32()), "nodes": [found.tobytes()]})

    return run


# growing -----------------------------------------------------------------------------

def grow(rows: DataFrame, features, estimator, block_rows: int = BLOCK_ROWS):
    """A forest of the estimator's settings on ordered rows, or None where Spark ML has to decide or complain."""
    features = list(features)
    given = settings(estimator, len(features))
    if given is None:
        return None
    spark, weight = rows.sparkSession, given.get("weightCol")
    complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features))
    held = rows.where(complete).select(
        *(F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)), F.col(given["labelCol"]).cast("double").alias("label"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
    )
    names = [f"f{i}" for i in range(len(features))]
    kinds = held.groupBy("label").agg(F.min("weight").alias("low"), F.max("weight").alias("high"), F.count_if(F.col("weight").isNull()).alias("none")).limit(101).collect()
    labels = [k["label"] for k in kinds]
    if not kinds or len(kinds) > 100 or any(y is None or y != y or y < 0 or y != int(y) or y > 99 for y in labels):
        return None
    if any(k["none"] or not 0 < k["low"] <= k["high"] < math.inf for k in kinds):
        return None
    classes = max(2, int(max(labels)) + 1)
    cuts = thresholds(held, names, given["maxBins"])
    by_class = {int(k["label"]): k["low"] for k in kinds}
    spec = {
        "n_features": len(features), "classes": classes, "n_bins": max(len(c) for c in cuts) + 1, "subset": given["subset"], "seed": given["seed"] & (1 << 63) - 1,
        "rate": given["subsamplingRate"], "weighted": any(k["low"] != k["high"] for k in kinds), "splits": [len(c) for c in cuts],
        "class_weights": [by_class.get(k, 0.0) for k in range(classes)], "least_rows": given["minInstancesPerNode"], "least_gain": given["minInfoGain"],
    }
    trees, depth = given["numTrees"], given["maxDepth"]
    # Nodes by heap number, children of n at 2n and 2n + 1.
    at = (trees, 2 << depth)
    feature, cut = np.zeros(at, dtype=np.int16), np.full(at, 255, dtype=np.uint8)  # no bin lies beyond: all rows go left
    weights, raw, gain = np.zeros((*at, classes)), np.zeros(at, dtype=np.int64), np.zeros(at)
    active = np.ones((trees, 1), dtype=bool)
    blocks = held.mapInArrow(_to_blocks(cuts, block_rows), _BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for level in range(depth):
            if not active.any():
                break
            slots = np.where(active, active.cumsum(1) - 1, -1).astype(np.int32)
            state = spark.sparkContext.broadcast((feature[:, : 1 << level], cut[:, : 1 << level], slots))
            counted = blocks.mapInArrow(_count(level, spec, state), _COUNTS)
            found = counted.groupBy("tree", "chunk").applyInArrow(_best(level, spec, state), _SPLITS).toArrow()
            state.destroy()
            nodes = [np.frombuffer(x).reshape(-1, 6 + 2 * classes) for x in found.column("nodes").to_pylist()]
            tree = np.repeat(found.column("tree").to_numpy(), [len(x) for x in nodes])
            table = np.concatenate(nodes) if nodes else np.zeros((0, 6 + 2 * classes))
            node = (1 << level) + table[:, 0].astype(np.int64)
            weights[tree, node], raw[tree, node] = table[:, 6:6 + classes], table[:, 4].astype(np.int64)
            split = table[:, 3] > 0
            tree, node, table = tree[split], node[split], table[split]
            feature[tree, node], cut[tree, node], gain[tree, node] = table[:, 1].astype(np.int16), table[:, 2].astype(np.uint8), table[:, 3]
            active = np.zeros((trees, 2 << level), dtype=bool)
            total, left = table[:, 6:6 + classes], table[:, 6 + classes:]
            for child, w, n in ((2 * node, left, table[:, 5]), (2 * node + 1, total - left, table[:, 4] - table[:, 5])):
                weights[tree, child], raw[tree, child] = w, n.astype(np.int64)
                active[tree, child - (2 << level)] = (gini(w) > 2.2e-16) & (level + 1 < depth)
    finally:
        blocks.unpersist()
    return _model(spark, estimator, cuts, feature, cut, weights, raw, gain)


# the model ---------------------------------------------------------------------------

def _model(spark, estimator, cuts, feature, cut, weights, raw, gain):
    """The forest as Spark ML stores it, nodes in preorder, loaded."""
    trees, places, classes = weights.shape
    leaf, said = gain <= 0, weights.argmax(2)
    size = np.ones((trees, places), dtype=np.int64)
    levels = [np.arange(1 << d, 2 << d) for d in range(places.bit_length() - 2)]
    for n in reversed(levels):  # leaves of one prediction become their parent
        left, right = 2 * n, 2 * n + 1
        same = leaf[:, left] & leaf[:, right] & (said[:, left] == said[:, right])
        said[:, n] = np.where(~leaf[:, n] & same, said[:, left], said[:, n])
        leaf[:, n] |= same
        size[:, n] = np.where(leaf[:, n], 1, 1 + size[:, left] + size[:, right])
    number = np.full((trees, places), -1, dtype=np.int64)
    number[:, 1] = 0
    for n in levels:
        inner = (number[:, n] >= 0) & ~leaf[:, n]
        number[:, 2 * n] = np.where(inner, number[:, n] + 1, -1)
        number[:, 2 * n + 1] = np.where(inner, number[:, n] + 1 + size[:, 2 * n], -1)
    tree, node = np.nonzero(number >= 0)
    inner = ~leaf[tree, node]
    f, below = np.where(inner, feature[tree, node], -1), np.minimum(2 * node, places - 2)
    known = np.full((len(cuts), 256), np.nan)
    for i, values in enumerate(cuts):
        known[i, : len(values)] = values
    ends = np.concatenate([[0], inner.cumsum()]).astype(np.int32)
    i4 = lambda v: pa.array(v.astype(np.int32))
    flat = spark.createDataFrame(pa.table({
        "tree": i4(tree), "id": i4(number[tree, node]), "prediction": pa.array(said[tree, node].astype(np.float64)),
        "impurity": pa.array(gini(weights[tree, node])),
        "stats": pa.ListArray.from_arrays(pa.array(np.arange(0, (len(tree) + 1) * classes, classes, dtype=np.int32)), pa.array(weights[tree, node].ravel())),
        "raw": pa.array(raw[tree, node]), "gain": pa.array(np.where(inner, gain[tree, node], -1.0)),
        "left": i4(np.where(inner, number[tree, below], -1)), "right": i4(np.where(inner, number[tree, below + 1], -1)), "feature": i4(f),
        "threshold": pa.ListArray.from_arrays(pa.array(ends), pa.array(known[f[inner], cut[tree, node][inner]])),
    }))
    split = F.struct(F.col("feature").alias("featureIndex"), F.col("threshold").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    node = F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("raw").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
    )
    path = staging_path(spark, "forest")
    flat.select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/data")
    chosen, usual = ({p.name: v for p, v in m.items()} for m in (estimator._paramMap, estimator._defaultParamMap))

    def meta(kind: str, uid: str, params, **more) -> str:
        whole = {"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        return json.dumps({**whole, "paramMap": params[0], "defaultParamMap": params[1], **more})

    forest_only = {"numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap"}
    of_tree = [{k: v for k, v in m.items() if k not in forest_only} for m in (chosen, usual)]
    spark.createDataFrame(
        [(i, meta("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[-12:]}", of_tree), 1.0) for i in range(trees)], "_1 int, _2 string, _3 double"
    ).coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = meta("RandomForestClassificationModel", estimator.uid, (chosen, usual), numFeatures=len(cuts), numClasses=classes, numTrees=trees)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)
