"""Committed zone runs: a stopped run taken up again, failing zones, retries; tiled blocks."""

import random

import pytest
from pyspark.sql import functions as F

from terracover.operators import tiles
from terracover.plans.zones import ZoneRun
from terracover.sources import sinks


def source(spark):
    return spark.range(300).selectExpr("CAST(id % 6 AS INT) AS zone", "CAST(id DIV 6 AS INT) AS r", "CAST(id % 7 AS INT) AS c", "id * 0.5D AS v")


def steps_of(spark, run, broken=(), calls=None):
    def features(zones):
        if calls is not None:
            calls.append(sorted(r["zone"] for r in zones.collect()))
        rows = source(spark).join(zones, "zone", "left_semi")
        bad = F.col("zone").isin(list(broken))
        return rows.withColumn("v", F.when(bad, F.raise_error(F.concat(F.lit("bad zone "), F.col("zone")))).otherwise(F.col("v")).cast("double"))

    def labels(zones):
        return source(spark).join(zones, "zone", "left_semi").where("zone <> 4").selectExpr("zone", "r", "c", "r % 2 AS label")

    def union(zones):
        return run.output("03_features", zones).join(run.output("04_labels", zones), ["zone", "r", "c"])

    return {"03_features": features, "04_labels": labels, "05_union": union}


def summary(df):
    return {r["zone"]: (r["status"], r["failed_step"], r["n_features"], r["n_labels"], r["n_union"]) for r in df.collect()}


def rows(df):
    return sorted(tuple(r) for r in df.select("zone", "r", "c", "v", "label").collect())


@pytest.fixture()
def expected(spark):
    return spark.range(8).selectExpr("CAST(id AS INT) AS zone")


WANT = {z: ("success", None, 50, 50, 50) for z in (0, 1, 2, 3, 5)} | {4: ("error", "04_labels", 50, 0, 0)} | {
    z: ("error", "03_features", 0, 0, 0) for z in (6, 7)
}


def test_stopped_run_taken_up_again_equals_one_run(spark, tmp_path, expected, monkeypatch):
    whole = ZoneRun(spark, f"{tmp_path}/whole")
    assert summary(whole.run(expected, steps_of(spark, whole))) == WANT

    class Stop(Exception):
        pass

    halted = ZoneRun(spark, f"{tmp_path}/halted")
    enter, entered = ZoneRun._enter, []

    def stop_at_second(self, table):
        entered.append(1)
        if len(entered) == 2:  # data of the second step is written, its entry is not
            raise Stop
        enter(self, table)

    monkeypatch.setattr(ZoneRun, "_enter", stop_at_second)
    with pytest.raises(Stop):
        halted.run(expected, steps_of(spark, halted))
    monkeypatch.setattr(ZoneRun, "_enter", enter)
    calls = []
    again = ZoneRun(spark, f"{tmp_path}/halted")
    assert summary(again.run(expected, steps_of(spark, again, calls=calls))) == WANT
    assert calls == []  # the first step was done for all zones
    assert rows(again.output("05_union")) == rows(whole.output("05_union"))


def test_failing_zones_stop_alone(spark, tmp_path, expected):
    run = ZoneRun(spark, f"{tmp_path}/run")
    outcome = run.run(expected, steps_of(spark, run, broken=(1, 3)))
    got = summary(outcome)
    assert got == WANT | {z: ("error", "03_features", 0, 0, 0) for z in (1, 3)}
    messages = {r["zone"]: r["message"] for r in outcome.collect()}
    assert "bad zone" in messages[1] and "bad zone" in messages[3] and messages[6] == "no rows"
    # The cause is mended: only failed zones run again.
    calls = []
    fixed = run.run(expected, steps_of(spark, run, calls=calls), retry_failed=True)
    assert calls == [[1, 3, 6, 7]]
    assert summary(fixed) == WANT


def test_a_finished_run_computes_nothing(spark, tmp_path, expected):
    run = ZoneRun(spark, f"{tmp_path}/run")
    run.run(expected, steps_of(spark, run))
    calls = []
    assert summary(run.run(expected, steps_of(spark, run, calls=calls))) == WANT
    assert calls == []


def pixels(spark):
    rng = random.Random(3)
    cells = sorted({(rng.randint(0, 1), rng.randint(0, 40), rng.randint(0, 25)) for _ in range(700)})
    data = [(z, r, c, rng.choice([0.25, rng.random()]), None if rng.random() < 0.1 else rng.random()) for z, r, c in cells]
    return spark.createDataFrame(data, "zone int, r int, c int, b1 double, b2 double")


@pytest.mark.parametrize("size", [1, 8, 16, 64])
def test_blocks_to_pixels_is_the_inverse(spark, size):
    px = pixels(spark)
    blocks = tiles.pixels_to_blocks(px, ["zone"], ["b1", "b2"], size)
    assert {r[0] for r in blocks.select(F.size("b1")).union(blocks.select(F.size("b2"))).collect()} == {size * size}
    back = tiles.blocks_to_pixels(blocks, ["zone"], ["b1", "b2"], size)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, px.collect()), key=repr)


def test_missing_cells_are_nodata_and_written_blocks_read_back(spark, tmp_path):
    px = spark.createDataFrame([(0, 1, 2, 0.5, None), (0, 3, 3, 0.25, 1.0)], "zone int, r int, c int, b1 double, b2 double")
    row = tiles.pixels_to_blocks(px, ["zone"], ["b1", "b2"], 4, nodata=-1.0).first()
    assert row["b1"] == [0.5 if i == 6 else 0.25 if i == 15 else -1.0 for i in range(16)]
    assert row["b2"] == [None if i == 6 else 1.0 if i == 15 else -1.0 for i in range(16)]
    sinks.write_blocks(px, f"{tmp_path}/blocks", ["zone"], ["b1", "b2"], 2, -1.0)
    back = tiles.blocks_to_pixels(spark.read.parquet(f"{tmp_path}/blocks"), ["zone"], ["b1", "b2"], 2, -1.0)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, px.collect()))


def test_two_pixels_in_a_cell_are_an_error(spark):
    px = spark.createDataFrame([(0, 1, 2, 0.5), (0, 1, 2, 0.7)], "zone int, r int, c int, b1 double")
    with pytest.raises(Exception, match="more than one pixel"):
        tiles.pixels_to_blocks(px, ["zone"], ["b1"], 4).collect()
    assert tiles.pixels_to_blocks(px.where("false"), ["zone"], ["b1"], 4).count() == 0


@pytest.mark.parametrize("use_masks", [False, True])
def test_committed_training_equals_the_joint_job(spark, sf_dir, tmp_path, use_masks):
    from terracover.operators.polygons import polygon_edges
    from terracover.plans import jobs
    from terracover.sources import landscape as land
    from terracover.sources.staging import stage

    px = stage(land.reflectances(spark, sf_dir).select("zone", "r", "c", "scene", "scl", "b02", "b8a", "ndvi"), "px")
    extent = stage(land.zone_extent(spark, sf_dir), "extent")
    edges = stage(polygon_edges(land.vertices(spark, sf_dir, extent)), "edges")
    run = ZoneRun(spark, f"{tmp_path}/run")
    outcome = run.run(extent.select("zone"), jobs.zone_steps(run, px, edges, extent, use_masks=use_masks))
    assert {r["status"] for r in outcome.collect()} == {"success"}
    want = jobs.build_training(px, edges, extent, use_masks=use_masks)
    got = run.output("05_union").select(want.columns)
    assert want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
