"""Georeferenced layers on grids: references, rotation, holes, cutting of edges."""

import math

import pytest
from pyspark.sql import functions as F

from terracover.operators.placement import change_crs, cut_edges, place_edges, place_layers

VERTICES = "zone int, layer string, poly_id int, ring int, seq int, x double, y double, epsg int"
GRID = "zone int, height int, width int, grid_epsg int, a double, b double, c double, d double, e double, f double"


def ring(points, epsg, ring_id=0, poly=1, zone=0, layer="forest"):
    return [(zone, layer, poly, ring_id, i, float(x), float(y), epsg) for i, (x, y) in enumerate(points)]


def cells(df):
    return {(r["r"], r["c"]) for r in df.collect()}


def inside(points, r, c):
    x, y, odd = c + 0.5, r + 0.5, False
    for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def test_reference_changes_return_to_the_start(spark):
    points = spark.createDataFrame([(-74.3, 5.1, 4326, 32618), (-74.3, 5.1, 4326, 32619), (-74.9, -0.8, 4326, 32718)], "x double, y double, s int, t int")
    there = change_crs(points, "x", "y", "s", "t", "e", "n")
    back = change_crs(there, "e", "n", "t", "s", "lon", "lat").collect()
    for r in back:
        assert abs(r["lon"] - r["x"]) < 1e-6 and abs(r["lat"] - r["y"]) < 1e-6
        assert r["n"] > 9_000_000 if r["t"] == 32718 else 500_000 < r["n"] < 600_000
    same = change_crs(points, "x", "y", "s", "s", "lon", "lat").collect()
    assert all((r["lon"], r["lat"]) == (r["x"], r["y"]) for r in same)


def test_unknown_reference_is_an_error(spark):
    grids = spark.createDataFrame([(0, 4, 4, 32618, 20.0, 0.0, 500000.0, 0.0, -20.0, 600000.0)], GRID)
    vertices = spark.createDataFrame(ring([(0, 0), (1, 0), (1, 1)], 3857), VERTICES)
    with pytest.raises(Exception, match="EPSG:3857"):
        place_layers(vertices, grids).collect()


def test_ring_in_another_utm_zone_covers_the_same_cells(spark):
    grids = spark.createDataFrame([(0, 60, 60, 32618, 20.0, 0.0, 560000.0, 0.0, -20.0, 600000.0)], GRID)
    degrees = [(-74.4580, 5.4270), (-74.4500, 5.4275), (-74.4495, 5.4190), (-74.4575, 5.4185)]
    one = spark.createDataFrame(ring(degrees, 4326), VERTICES)
    moved = change_crs(one.withColumn("t", F.lit(32617)), "x", "y", "epsg", "t", "e", "n")
    other = moved.select("zone", "layer", "poly_id", "ring", "seq", F.col("e").alias("x"), F.col("n").alias("y"), F.col("t").alias("epsg"))
    first = cells(place_layers(one, grids))
    # Straight lines of the two references differ by far less than a cell here.
    assert len(first) > 500 and len(first ^ cells(place_layers(other, grids))) <= 0.01 * len(first)


def test_holes_and_rotated_grids(spark):
    turn = math.radians(30)
    a, b, d, e = 20 * math.cos(turn), 20 * math.sin(turn), 20 * math.sin(turn), -20 * math.cos(turn)
    grids = spark.createDataFrame([(0, 30, 30, 32618, a, b, 500000.0, d, e, 600000.0)], GRID)
    outer, hole = [(3.2, 4.1), (25.3, 5.6), (22.4, 26.7), (4.8, 21.9)], [(10.1, 10.2), (16.3, 11.4), (13.7, 17.6)]
    world = lambda ps: [(a * x + b * y + 500000.0, d * x + e * y + 600000.0) for x, y in ps]
    vertices = spark.createDataFrame(ring(world(outer), 32618) + ring(world(hole), 32618, 1), VERTICES)
    want = {(r, c) for r in range(30) for c in range(30) if inside(outer, r, c) and not inside(hole, r, c)}
    assert cells(place_layers(vertices, grids)) == want
    assert {(r["ring"], r["part"]) for r in place_edges(vertices, grids).collect()} == {(0, 0), (1, 0)}


def test_geographic_grid_takes_metric_rings(spark):
    grids = spark.createDataFrame([(0, 40, 40, 4326, 0.0002, 0.0, -75.0, 0.0, -0.0002, 5.43)], GRID)
    vertices = spark.createDataFrame(ring([(500100, 600050), (500700, 600020), (500650, 599500), (500150, 599600)], 32618), VERTICES)
    edges = place_edges(vertices, grids, longest=2.0).collect()
    assert len(edges) > 40
    ends = {(r["x1"], r["y1"]) for r in edges}
    assert ends == {(r["x2"], r["y2"]) for r in edges}  # closed without a gap
    assert cells(place_layers(vertices, grids, 2.0)) == cells(place_layers(vertices, grids, 0.5))


def test_cut_edges_share_their_ends(spark):
    edges = spark.createDataFrame([(1, 0.1, 0.2, 9.7, 3.3), (2, 1.0, 1.0, 1.5, 1.0)], "id int, x1 double, y1 double, x2 double, y2 double")
    rows = cut_edges(edges, F.ceil(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))))).orderBy("id", "part").collect()
    assert [(r["id"], r["part"]) for r in rows] == [(1, k) for k in range(10)] + [(2, 0)]
    assert rows[0]["x1"] == 0.1 and rows[9]["x2"] == 9.7
    assert all((p["x2"], p["y2"]) == (q["x1"], q["y1"]) for p, q in zip(rows, rows[1:10]))
