"""Outlines of cell sets: round trips, orientation, corners that touch, long spirals."""

import random

from pyspark.sql import functions as F

from terracover.operators.polygons import polygon_cells
from terracover.operators.rings import dissolved_rings, ring_edges, ring_measures


def frame(spark, sets):
    return spark.createDataFrame([(z, "forest", r, c) for z, held in sets.items() for r, c in held], "zone int, layer string, r int, c int")


def filled(spark, vertices, size):
    extent = spark.createDataFrame([(z, size, size) for z in range(4)], "zone int, height int, width int")
    return {(r["zone"], r["r"], r["c"]) for r in polygon_cells(ring_edges(vertices), extent).collect()}


def test_random_sets_return(spark):
    rng = random.Random(9)
    sets = {z: {(r, c) for r in range(14) for c in range(14) if rng.random() < share} for z, share in enumerate((0.1, 0.5, 0.9))}
    sets[3] = {(r, c) for r in range(14) for c in range(14) if (r + c) % 2}  # all corners touch
    vertices = dissolved_rings(frame(spark, sets)).cache()
    assert filled(spark, vertices, 14) == {(z, r, c) for z, held in sets.items() for r, c in held}
    measured = ring_measures(vertices)
    area = {r["zone"]: r["a"] for r in measured.groupBy("zone").agg(F.sum("area").alias("a")).collect()}
    assert area == {z: len(held) for z, held in sets.items()}
    lonely = measured.where("zone = 3").collect()
    assert len(lonely) == len(sets[3]) and all((r["n_corners"], r["perimeter"], r["area"]) == (4, 4, 1) for r in lonely)


def test_holes_run_against_their_outline(spark):
    ring = {(r, c) for r in range(7) for c in range(7)} - {(r, c) for r in range(2, 5) for c in range(2, 5)}
    ring |= {(3, 3)}
    got = sorted((r["area"], r["n_corners"], r["perimeter"]) for r in ring_measures(dissolved_rings(frame(spark, {0: ring}))).collect())
    assert got == [(-9, 4, 12), (1, 4, 4), (49, 4, 28)]


def test_vertices_follow_the_outline(spark):
    rows = dissolved_rings(frame(spark, {0: {(0, 0), (0, 1), (1, 0)}})).orderBy("seq").collect()
    assert [(r["x"], r["y"]) for r in rows] == [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)]
    assert len({r["ring"] for r in rows}) == 1


def test_a_long_spiral_is_one_ring(spark):
    size, cells, seen = 41, [], set()
    r, c, dr, dc = 0, 0, 0, 1
    while True:
        cells.append((r, c))
        seen.add((r, c))
        ahead, two = (r + dr, c + dc), (r + 2 * dr, c + 2 * dc)
        if not (0 <= ahead[0] < size and 0 <= ahead[1] < size) or ahead in seen or two in seen:
            dr, dc = dc, -dr
            ahead, two = (r + dr, c + dc), (r + 2 * dr, c + 2 * dc)
            if not (0 <= ahead[0] < size and 0 <= ahead[1] < size) or ahead in seen or two in seen:
                break
        r, c = ahead
    measured = ring_measures(dissolved_rings(frame(spark, {0: set(cells)}))).collect()
    assert len(measured) == 1 and measured[0]["area"] == len(cells) and measured[0]["perimeter"] == 2 * len(cells) + 2


def test_no_cells_no_rings(spark):
    assert dissolved_rings(frame(spark, {0: set()})).count() == 0
