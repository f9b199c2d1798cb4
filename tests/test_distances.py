"""L1 distances, dilation and erosion against brute force, and their size at large radii."""

import random

import pytest
from pyspark.sql import functions as F

from terracover.operators import morphology
from terracover.operators.morphology import ball, dilate, dilate_flags, erode, l1_depth, l1_reach


def sets(seed=1):
    """Cells of three keys: sparse, dense and ragged; some at negative places and across tile borders."""
    rng = random.Random(seed)
    out = {0: set(), 1: set(), 2: set()}
    for r in range(-6, 14):
        for c in range(250, 275):
            for k, share in ((0, 0.04), (1, 0.93), (2, 0.6)):
                if rng.random() < share:
                    out[k].add((r, c))
    out[0] |= {(-300, -300), (600, 5)}
    return out


def frame(spark, cells):
    return spark.createDataFrame([(k, r, c) for k, held in cells.items() for r, c in held], "zone int, r int, c int")


def collected(df, value=None):
    rows = df.collect()
    got = {(x["zone"], x["r"], x["c"]): x[value] if value else 1 for x in rows}
    assert len(got) == len(rows)  # every cell once
    return got


@pytest.mark.parametrize("radius", [1, 2, 3, 7])
def test_reach_equals_the_ball(spark, radius):
    cells = sets()
    want = {}
    for k, held in cells.items():
        for r, c in held:
            for dr, dc in ball(radius):
                at = (k, r + dr, c + dc)
                want[at] = min(want.get(at, radius), abs(dr) + abs(dc))
    assert collected(l1_reach(frame(spark, cells), ["zone"], radius), "distance") == want
    assert collected(dilate(frame(spark, cells), ["zone"], radius)).keys() == want.keys()


@pytest.mark.parametrize("limit", [1, 2, 3, 8])
def test_depth_equals_the_nearest_gap(spark, limit):
    cells = sets(2)
    want = {
        (k, r, c): min([limit, *(abs(dr) + abs(dc) for dr, dc in ball(limit) if (r + dr, c + dc) not in held)])
        for k, held in cells.items() for r, c in held
    }
    assert collected(l1_depth(frame(spark, cells), ["zone"], limit), "depth") == want
    eroded = collected(erode(frame(spark, cells), ["zone"], limit - 1)).keys()
    assert eroded == {at for at, d in want.items() if d > limit - 1}


def test_borders_of_tiles_do_not_show(spark, monkeypatch):
    monkeypatch.setattr(morphology, "TILE_BITS", 2)
    block = {5: {(r, c) for r in range(-20, 20) for c in range(-20, 20) if (r, c) != (3, 4)}}
    depth = collected(l1_depth(frame(spark, block), ["zone"], 30), "depth")
    assert all(d == min(r + 21, 20 - r, c + 21, 20 - c, abs(r - 3) + abs(c - 4)) for (_, r, c), d in depth.items())
    near = collected(l1_reach(frame(spark, {5: {(0, 0), (0, 9)}}), ["zone"], 6), "distance")
    assert near == {(5, r, c): min(abs(r) + abs(c), abs(r) + abs(c - 9)) for r in range(-6, 7) for c in range(-6, 16)
                    if min(abs(r) + abs(c), abs(r) + abs(c - 9)) <= 6}


def test_flags_grow_over_given_cells_only(spark):
    rows = [(1, r, c, int((r, c) in {(5, 5), (9, 1)})) for r in range(12) for c in range(12) if (r + c) % 5] + [(1, 5, 5, 0)]
    df = spark.createDataFrame(rows, "zone int, r int, c int, bad int")
    for radius in (0, 2, 4):
        got = collected(dilate_flags(df, ["zone"], "bad", radius), "bad")
        flagged = [(r, c) for _, r, c, b in rows if b]
        assert got == {(1, r, c): int(any(abs(r - x) + abs(c - y) <= radius for x, y in flagged)) for _, r, c, _ in rows}


def test_rows_do_not_grow_with_the_radius(spark):
    """A block of 90 x 90 cells, radius 30: rows written by all exchanges stay within a few per cell."""
    block = spark.range(8100).select(F.lit(1).alias("zone"), F.expr("CAST(id DIV 90 AS INT)").alias("r"), F.expr("CAST(id % 90 AS INT)").alias("c"))

    def rows_shuffled(df):
        df.collect()
        plan, total = [df._jdf.queryExecution().executedPlan()], 0
        while plan:
            node = plan.pop()
            name = node.nodeName()
            if name == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            if name == "AdaptiveSparkPlan":
                plan.append(node.executedPlan())
            elif name.endswith("QueryStage"):
                plan.append(node.plan())
            children = node.children()
            plan += [children.apply(i) for i in range(children.size())]
        return total

    deep = erode(block, ["zone"], 30)
    assert deep.count() == 30 * 30
    few, many = rows_shuffled(erode(block, ["zone"], 5)), rows_shuffled(deep)
    assert 8100 <= few <= many <= 4 * 8100
    grown = dilate(block, ["zone"], 30)
    assert grown.count() == 90 * 90 + 4 * 90 * 30 + 4 * sum(range(30))
    assert rows_shuffled(grown) <= 3 * grown.count()
