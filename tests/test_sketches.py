"""Quantile sketches: rank error below the bound, size, merging in any order, scene thresholds."""

import bisect

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracover.operators import sketches
from terracover.operators.masks import scene_thresholds


def readings(n=40_000):
    rng = np.random.default_rng(4)
    return {0: rng.random(n), 1: np.clip(rng.normal(0.3, 0.05, n), 0, 1), 2: rng.choice([0.1, 0.2, 0.9], n), 3: rng.random(30), 4: rng.beta(0.3, 3, n)}


@pytest.fixture(scope="module")
def table(spark):
    data = readings()
    rows = [(k, float(v), i % 3) for k, held in data.items() for i, v in enumerate(held)]
    return spark.createDataFrame(rows + [(0, None, 0), (1, float("nan"), 1)], "scene int, v double, file int").repartition(6).cache()


SHARES = {"p0": 0.0, "p5": 0.05, "p20": 0.2, "p50": 0.5, "p80": 0.8, "p99": 0.99, "p100": 1.0}


def worst_error(found, data):
    worst = 0.0
    for r in found.collect():
        held = sorted(np.floor(data[r["scene"]] * sketches.TOP + 0.5).astype(int).tolist())
        for name, q in SHARES.items():
            code, want = round(r[name] * sketches.TOP), q * (len(held) - 1)
            low, high = bisect.bisect_left(held, code), bisect.bisect_right(held, code) - 1
            worst = max(worst, max(0.0, low - want - 1, want - high - 1) / len(held))
    return worst


@pytest.mark.parametrize("k", [100, 400, 3200])
def test_rank_error_and_size_stay_below_their_bounds(table, k):
    nodes = sketches.sketch(table, ["scene"], "v", k).cache()
    assert worst_error(sketches.quantile(nodes, ["scene"], SHARES), readings()) <= sketches.rank_bound(k)
    sizes = {r["scene"]: (r["nodes"], r["total"]) for r in nodes.groupBy("scene").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("total")).collect()}
    assert {s: t for s, (_, t) in sizes.items()} == {s: len(v) for s, v in readings().items()}
    assert all(n <= 3 * k for n, _ in sizes.values())
    # Counts above the leaves are at most a k-th of the group.
    over = nodes.where("level > 0").groupBy("scene").agg(F.max("n").alias("n")).collect()
    assert all(r["n"] <= sizes[r["scene"]][1] // k for r in over)


def test_merging_files_in_any_order_gives_one_sketch_within_the_bound(table):
    k = 400
    parts = [sketches.sketch(table.where(F.col("file") == f), ["scene"], "v", k) for f in range(3)]
    rows = lambda nodes: sorted(map(tuple, nodes.select("scene", "level", "node", "n").collect()))
    one = sketches.merge(parts, ["scene"], k)
    assert rows(one) == rows(sketches.merge(parts[::-1], ["scene"], k))
    assert worst_error(sketches.quantile(one, ["scene"], SHARES), readings()) <= sketches.rank_bound(k)
    stepwise = sketches.merge([sketches.merge(parts[:2], ["scene"], k), parts[2]], ["scene"], k)
    assert worst_error(sketches.quantile(stepwise, ["scene"], SHARES), readings()) <= 2 * sketches.rank_bound(k)


def test_small_scenes_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(0, s, 4, float(round(a, 3)), float(b)) for s in range(3) for a, b in zip(rng.random(200), rng.random(200) - 0.3)]
    px = spark.createDataFrame(rows, "zone int, scene int, scl int, b8a double, ndvi double")
    exact = {r["scene"]: (r["bright"], r["dark"]) for r in scene_thresholds(px).collect()}
    for r in sketches.sketched_thresholds(sketches.scene_sketches(px)).collect():
        values = sorted(v for _, s, _, v, _ in rows if s == r["scene"])
        step = max(b - a for a, b in zip(values, values[1:]))
        assert abs(r["bright"] - exact[r["scene"]][0]) <= step and abs(r["dark"] - exact[r["scene"]][1]) <= step


def test_no_readings(spark):
    empty = spark.createDataFrame([], "scene int, v double")
    assert sketches.quantile(sketches.sketch(empty, ["scene"], "v"), ["scene"], SHARES).count() == 0
