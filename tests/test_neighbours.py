"""Exact neighbours and interpolated rows against brute force; folds of spatial blocks."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terracover.operators.neighbours import nearest_neighbours, oversample_interpolated
from terracover.operators.splits import grouped_folds


def points(n=260, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = None if i % 50 == 49 else i % 3 // 2
        place = (rng.choice([0.0, 5.0]) + rng.gauss(0, 1), rng.gauss(0, 1), rng.choice([1.0, 2.0]))
        out.append((f"k{i:04d}", kind, *place))
    return out + [("twin1", 0, 1.0, 1.0, 1.0), ("twin2", 0, 1.0, 1.0, 1.0), ("alone", 7, 0.0, 0.0, 0.0)]


@pytest.mark.parametrize("block_rows, k", [(4, 3), (16, 5), (10_000, 5), (3, 6)])
def test_neighbours_are_exact(spark, block_rows, k):
    rows = points()
    df = spark.createDataFrame(rows, "id string, kind int, a double, b double, c double")
    got = {r["key"]: [(x["key"]) for x in r["near"]] for r in nearest_neighbours(df, "id", "kind", ["a", "b", "c"], k, block_rows).collect()}
    want = {}
    for i, kind, *f in rows:
        others = [(sum((x - y) ** 2 for x, y in zip(f, g)), j) for j, other, *g in rows if other == kind and j != i]
        want[i] = [j for _, j in sorted(others)[:k]]
    assert got == want


def test_synthetic_rows_lie_between_neighbours(spark):
    rng = random.Random(5)
    rows = [(i, i % 10 == 0, rng.random(), rng.random()) for i in range(400)] + [(900, True, None, 0.5), (901, True, float("nan"), 0.5)]
    df = spark.createDataFrame(rows, "id int, rare boolean, a double, b double").withColumn("label", F.col("rare").cast("int")).drop("rare")
    made = oversample_interpolated(df, "label", ["id"], ["a", "b"], ratio=0.5, k=4, block_rows=8)
    found = made.collect()
    assert sorted(map(repr, made.collect())) == sorted(map(repr, found))  # reruns agree
    assert Counter(r["label"] for r in found if r["copy"] > 1) == {1: 180 - 40}
    assert len([r for r in found if r["copy"] == 1]) == len(rows)
    rare = {i: (a, b) for i, y, a, b in rows if y and i < 900}
    for r in (x for x in found if x["copy"] > 1):
        own = rare[r["id"]]
        near = sorted((math.dist(own, p), p) for i, p in rare.items() if i != r["id"])[:4]
        gaps = []
        for _, p in near:  # distance from the segment
            length = math.dist(own, p) ** 2
            u = sum((x - o) * (q - o) for x, o, q in zip((r["a"], r["b"]), own, p)) / length
            gaps.append(math.dist((r["a"], r["b"]), [o + min(max(u, 0), 1) * (q - o) for o, q in zip(own, p)]))
        assert min(gaps) < 1e-9


def test_a_single_row_is_repeated_and_no_rows_give_none(spark):
    df = spark.createDataFrame([(i, 0, i * 0.1) for i in range(10)] + [(99, 1, 0.7)], "id int, label int, a double")
    made = oversample_interpolated(df, "label", ["id"], ["a"], ratio=0.3).where("copy > 1").collect()
    assert [(r["id"], r["a"]) for r in made] == [(99, 0.7)] * 2
    assert oversample_interpolated(df.where("false"), "label", ["id"], ["a"]).count() == 0


def test_folds_keep_blocks_whole_and_even(spark):
    rng = random.Random(6)
    rows = []
    for zone in range(3):
        for r in range(96):
            for c in range(60):
                if rng.random() < 0.8:
                    rows.append((zone, r, c, int((r // 20 + c // 15 + zone) % 3 == 0) if rng.random() < 0.9 else 1))
    df = spark.createDataFrame(rows, "zone int, r int, c int, label int")
    found = grouped_folds(df, "label", block=6).collect()
    assert len(found) == len(rows)
    blocks, sizes, ones, of = defaultdict(set), Counter(), Counter(), Counter()
    for x in found:
        at = (x["zone"], x["r"] // 6, x["c"] // 6)
        blocks[at].add(x["fold"])
        sizes[x["fold"]] += 1
        ones[x["fold"]] += x["label"]
        of[at] += 1
    assert all(len(f) == 1 for f in blocks.values()) and set(sizes) == set(range(5))
    assert max(sizes.values()) - min(sizes.values()) <= 5 * max(of.values())  # a block per kind at most
    share = sum(ones.values()) / len(rows)
    assert all(abs(ones[f] / sizes[f] - share) < 0.03 for f in sizes)
    hashed = grouped_folds(df.orderBy(F.rand(3)), "label", block=6).collect()
    assert sorted(map(tuple, hashed)) == sorted(map(tuple, found))


def test_tuning_takes_the_given_folds(spark):
    from terracover.operators.models import tune

    rng = random.Random(7)
    rows = [(0, i // 12, i % 12, rng.random(), i) for i in range(144)]
    df = spark.createDataFrame(rows, "zone int, r int, c int, a double, i int").withColumn("label", (F.col("a") > 0.5).cast("int"))
    folded = grouped_folds(df.withColumn("class_weight", F.lit(1.0)), "label", block=3, folds=3)
    _, params, best = tune(folded, ["a"], "RandomForest", {"numTrees": [3], "maxDepth": [2]}, method="folds", folds=3, fold_col="fold", parallelism=1)
    assert params == {"numTrees": 3, "maxDepth": 2} and best > 0.9


def test_rows_meet_near_cells_only(spark, monkeypatch):
    """In three features rows ask a few of 64 cells; a cut along one of them alone reached 10 and more."""
    from terracover.operators import neighbours

    rng = random.Random(9)
    rows = [(f"k{i}", 0, rng.random(), rng.random(), rng.random()) for i in range(4096)]
    df = spark.createDataFrame(rows, "id string, kind int, a double, b double, c double")
    asked, reached = [], neighbours._reached

    def counted(boxes):
        inner = reached(boxes)
        asked.append(spark.sparkContext.accumulator(0))

        def run(batches, seen=asked[-1]):
            for batch in inner(batches):
                seen.add(batch.num_rows)
                yield batch

        return run

    monkeypatch.setattr(neighbours, "_reached", counted)
    got = {r["key"]: [x["key"] for x in r["near"]] for r in nearest_neighbours(df, "id", "kind", ["a", "b", "c"], 3, 64).collect()}
    for i, _, *f in rows[:40]:
        others = sorted((sum((x - y) ** 2 for x, y in zip(f, g)), j) for j, _, *g in rows if j != i)
        assert got[i] == [j for _, j in others[:3]]
    assert 0 < asked[0].value < 6 * len(rows)


def test_copies_of_a_row_fill_many_cells(spark):
    rows = [(f"k{i:03d}", 0, 1.0, 2.0) for i in range(300)] + [("z", 0, float("inf"), 0.0), ("y", 0, 1.0, 2.5)]
    df = spark.createDataFrame(rows, "id string, kind int, a double, b double")
    near = {r["key"]: [x["key"] for x in r["near"]] for r in nearest_neighbours(df, "id", "kind", ["a", "b"], 2, 8).collect()}
    assert near["k000"] == ["k001", "k002"] and near["k299"] == ["k000", "k001"] and near["y"] == ["k000", "k001"]
    assert near["z"] == ["k000", "k001"]
