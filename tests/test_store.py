"""Stored pixel tables: row groups skipped by bounds, joins and groupings without an exchange."""

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from terracover.operators.masks import clear_mask, clear_scenes
from terracover.operators.polygons import clip_to_layer, polygon_edges
from terracover.plans import jobs
from terracover.plans.oracles import oracle_sql
from terracover.sources import landscape as land
from terracover.sources import store
from terracover.sources.staging import stage, staging_path


def final_plan(df):
    """Nodes of the plan that ran, stages of adaptive execution opened."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        found.append(node)
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def names(df):
    return [n.nodeName().split(" ")[0] for n in final_plan(df)]


@pytest.fixture(scope="module")
def pixels(spark, sf_dir):
    columns = ["zone", "r", "c", "scene", "scl", *land.BANDS, "ndvi", "ndwi"]
    return stage(land.reflectances(spark, sf_dir).select(*columns), "px")


def test_training_from_buckets_needs_no_exchange(spark, pixels):
    labels = pixels.select("zone", "r", "c").distinct().withColumn("label", (F.col("c") % 3 - 1).cast("smallint"))
    obs = store.store_buckets(pixels.where("b02 <> 0"), 8, name="obs")
    rows = jobs.stored_training(obs, store.store_buckets(labels, 8, name="labels"))
    plan = names(rows)
    assert plan.count("SortMergeJoin") == 1
    assert not [n for n in plan if "Exchange" in n]
    want = jobs.join_labels(jobs.temporal_composite(pixels.where("b02 <> 0")), labels)
    assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()


def test_masked_composite_from_buckets_needs_no_exchange(spark, sf_dir, pixels):
    scenes = store.store_buckets(clear_scenes(clear_mask(pixels)), 8, name="clear")
    rows = jobs.stored_masked_composite(store.store_buckets(pixels, 8, name="px"), scenes)
    plan = names(rows)
    assert plan.count("SortMergeJoin") == 1
    assert not [n for n in plan if "Exchange" in n]


def test_buckets_of_different_powers_still_meet(spark, pixels):
    cells = pixels.select("zone", "r", "c").distinct()
    many, few = store.store_buckets(pixels, 16, name="many"), store.store_buckets(cells, 8, name="few")
    joined = many.join(few.hint("merge"), ["zone", "r", "c"])
    assert joined.count() == pixels.count()


@pytest.mark.parametrize("rows, buckets", [(0, 8), (1, 8), (8 << 22, 8), ((8 << 22) + 1, 16), (10**12, 1 << 18)])
def test_bucket_count(rows, buckets):
    assert store.bucket_count(rows) == buckets


def test_bounds_reach_the_scan_and_skip_rows(spark, tmp_path):
    wide = spark.range(400 * 400).select(
        F.expr("CAST(id % 4 AS INT) AS zone"), F.expr("CAST(id DIV 400 AS INT) AS r"), F.expr("CAST(id % 400 AS INT) AS c"), F.rand(1).alias("b02")
    )
    path = str(tmp_path / "sorted")
    store.write_sorted(wide, path, row_group_bytes=64 << 10)
    points = [(2, "forest", 1, i, x, y) for i, (x, y) in enumerate([(20.3, 30.2), (60.7, 33.1), (41.2, 70.9)])]
    edges = polygon_edges(spark.createDataFrame(points, "zone int, layer string, poly_id int, seq int, x double, y double"))
    extent = stage(spark.createDataFrame([(z, 400, 400) for z in range(4)], "zone int, height int, width int"), "extent")
    bounds = store.layer_bounds(edges, extent)
    assert bounds == [(2, 2, 30, 70, 20, 60)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    near = store.within(spark.read.parquet(path), bounds)
    scan = [n for n in final_plan(near) if n.nodeName().startswith(("Scan", "BatchScan"))][0]
    text = near._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = text[text.index("PushedFilters"):]
    assert "EqualTo(zone,2)" in pushed and "GreaterThanOrEqual(r,30)" in pushed and "LessThanOrEqual(c,60)" in pushed
    assert scan.metrics().apply("numOutputRows").value() < 0.25 * 160_000
    clipped, whole = (clip_to_layer(px, edges, extent, "forest") for px in (near, spark.read.parquet(path)))
    assert clipped.count() > 100
    assert clipped.exceptAll(whole).isEmpty() and whole.exceptAll(clipped).isEmpty()


def test_many_zones_share_bounds_and_none_give_no_rows(spark):
    edges = spark.createDataFrame([(z, "f", 1.2, 2.6 + z, 9.4, 8.8 + z) for z in range(10)] + [(10, "f", -9.0, -9.0, -3.0, -4.0)],
                                  "zone int, layer string, x1 double, y1 double, x2 double, y2 double")
    extent = spark.createDataFrame([(z, 30, 8) for z in range(11)], "zone int, height int, width int")
    bounds = store.layer_bounds(edges, stage(extent, "extent"), most=3)
    assert len(bounds) == 3 and bounds[0][:2] == (0, 3) and bounds[-1][:2] == (7, 9)
    px = spark.range(11 * 30 * 8).selectExpr("CAST(id % 11 AS INT) zone", "CAST(id DIV 11 % 30 AS INT) r", "CAST(id DIV 330 AS INT) c")
    inside = px.where("zone < 10 AND r >= zone + 3 AND r <= zone + 8 AND c >= 1")
    assert inside.exceptAll(store.within(px, bounds)).isEmpty()
    assert store.within(px, []).isEmpty()


def test_stored_query_equals_oracle_at_a_larger_scale(spark):
    import os

    import __spark_entry__ as entry

    medium = "/root/testdata/sf0.01"
    if not os.path.isdir(medium):
        pytest.skip("driver tables are not available")
    for name in ("clip_pruned", "training_table_stored"):
        found = entry.queries()[name](spark, medium)
        assert not found.isEmpty()
        assert differences(found, connect(medium), oracle_sql()[name]) == []


def test_staged_tables_can_be_dropped(spark, sf_dir):
    import os

    from terracover.sources.staging import drop_staged

    drop_staged(spark)
    first = stage(spark.range(5), "first")
    stage(spark.range(7), "second")
    files = [f.removeprefix("file://") for f in first.inputFiles()]
    assert first.count() == 5 and all(map(os.path.exists, files))
    assert drop_staged(spark) == 2 and not any(map(os.path.exists, files))
    assert drop_staged(spark) == 0
