"""Readers, sinks, catalogs, models and the end-to-end jobs."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terracover.operators import models
from terracover.operators.polygons import polygon_edges
from terracover.operators.splits import hash_split
from terracover.operators.weights import add_class_weight
from terracover.plans import jobs
from terracover.sources import catalog, landscape as land, sinks, staging
from terracover.sources.readers import raster_to_pixels, read_union, read_zones

KEYS = ("zone", "r", "c")


def rows_of(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


# readers and sinks -----------------------------------------------------------------

def test_read_union_by_name_and_glob(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, s string").write.parquet(f"{tmp_path}/one")
    spark.createDataFrame([(2, 3.0)], "id int, v double").write.parquet(f"{tmp_path}/two")
    both = read_union(spark, f"{tmp_path}/one, {tmp_path}/two")
    assert rows_of(both, "id", "s", "v") == {(1, "a", None), (2, None, 3.0)}
    with pytest.raises(ValueError):
        read_union(spark, " , ")


def test_zone_table_round_trip_and_tolerant_read(spark, tmp_path):
    df = spark.range(60).selectExpr("CAST(id % 3 AS INT) AS zone", "CAST(id AS INT) AS r", "1 AS c", "id * 0.5D AS v")
    path = f"{tmp_path}/zones"
    sinks.write_zones(df, path)
    assert rows_of(read_zones(spark, path), "zone", "r", "v") == rows_of(df, "zone", "r", "v")
    (tmp_path / "zones" / "zone=1" / "part-broken.parquet").write_bytes(b"not parquet at all")
    assert read_zones(spark.newSession(), path, tolerant=True).where("zone = 0").count() == 20


def test_scene_table_prunes_partitions(spark, tmp_path):
    df = spark.range(40).selectExpr("CAST(id % 2 AS INT) AS zone", "CAST(id % 4 AS INT) AS scene",
                                    "CAST(id AS INT) AS r", "0 AS c", "0.5D AS b02")
    sinks.write_scenes(df, f"{tmp_path}/scenes")
    back = spark.read.parquet(f"{tmp_path}/scenes").where("zone = 1 AND scene = 3")
    assert back.count() == 10 and len(back.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(zone" in back._jdf.queryExecution().executedPlan().toString()


def test_csv_and_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([("ndvi", 0.5, {"a": 1})], "name string, v double, m map<string,int>")
    sinks.write_table(df.drop("m"), f"{tmp_path}/t", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/t").first()["name"] == "ndvi"
    sinks.write_json(df, f"{tmp_path}/j")
    assert json.loads(spark.read.text(f"{tmp_path}/j").first()[0]) == {"name": "ndvi", "v": 0.5, "m": {"a": 1}}
    with pytest.raises(ValueError):
        sinks.write_table(df, f"{tmp_path}/x", "orc")


def test_raster_blocks_unfold_row_major(spark):
    blocks = spark.createDataFrame([(1, [1.0, 0.0, 3.0, 4.0], [9.0, 8.0, 7.0, 6.0])],
                                   "block int, red array<double>, nir array<double>")
    got = rows_of(raster_to_pixels(blocks, ["block"], ["red", "nir"], 2), "r", "c", "red", "nir")
    assert got == {(0, 0, 1.0, 9.0), (1, 0, 3.0, 7.0), (1, 1, 4.0, 6.0)}
    assert raster_to_pixels(blocks, ["block"], ["red"], 2, nodata=None).count() == 4


def test_catalog_of_a_small_listing(spark):
    name = "S2A_MSIL2A_20200112T153621_N0500_R025_T18NWL_20200112T153621"
    keys = [f"z1/{name}.SAFE/GRANULE/L2A/IMG_DATA/R20m/T18NWL_{b}_20m.jp2" for b in ("B02", "B8A")]
    keys += [f"z1/{name}.SAFE/GRANULE/L2A/IMG_DATA/R60m/T18NWL_B04_60m.jp2", "z1/readme.txt"]
    paths = spark.createDataFrame([(k,) for k in keys], "path string")
    assert rows_of(catalog.product_catalog(paths), "zone", "product") == {("z1", name)}
    assert rows_of(catalog.band_file_lookup(paths), "band") == {("B02",), ("B8A",)}
    missing = catalog.missing_bands(paths, ["b02", "b04"])
    assert rows_of(missing, "band", "unusable") == {("B04", False)}


def test_staging_needs_a_shared_folder_on_a_cluster(spark):
    class Session:
        class conf:
            values = {"spark.master": "yarn"}

            @classmethod
            def get(cls, key, default=None):
                return cls.values.get(key, default)

    with pytest.raises(ValueError):
        staging.staging_root(Session)
    Session.conf.values["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert staging.staging_path(Session, "t").startswith("hdfs:///shared/t-")


# models ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(1200).selectExpr(
        "CAST(id % 2 AS INT) AS zone", "CAST(id AS INT) AS r", "0 AS c",
        "(id * 7919 % 1000) / 1000D AS ndvi_med", "(id * 104729 % 1000) / 1000D AS b04_med", "id % 13 AS n_obs",
    )
    return df.withColumn("label", (F.col("ndvi_med") + 0.2 * F.col("b04_med") > 0.8).cast("int")).cache()


@pytest.fixture(scope="module")
def split_rows(table):
    return add_class_weight(hash_split(table, KEYS))


FEATURES = ["ndvi_med", "b04_med", "n_obs"]


def test_refit_model_carries_tuned_parameters(split_rows):
    model, best, _ = models.tune(
        split_rows, FEATURES, "RandomForest", {"numTrees": [3], "maxDepth": [2]}, parallelism=2
    )
    assert best == {"numTrees": 3, "maxDepth": 2}
    final = models.refit(split_rows, FEATURES, "RandomForest", best)
    assert (final.stages[-1].getNumTrees, final.stages[-1].getOrDefault("maxDepth")) == (3, 2)


def test_published_grid_sizes(spark):
    for family, grid in (("RandomForest", models.RF_GRID), ("GBT", models.GBT_GRID)):
        assert len(models.param_grid(models.classifier(family), grid)) == 36


def test_cross_validation_method(split_rows):
    _, best, score = models.tune(split_rows, FEATURES, "GBT", {"maxIter": [2], "maxDepth": [2]},
                                 method="folds", folds=2, parallelism=2)
    assert best["maxIter"] == 2 and 0.5 < score <= 1


def test_ties_go_to_boosting():
    assert models.choose({"RandomForest": 0.9, "GBT": 0.9}) == "GBT"
    assert models.choose({"RandomForest": 0.91, "GBT": 0.9}) == "RandomForest"


def test_saved_model_predicts_the_same(spark, split_rows, tmp_path):
    model = models.refit(split_rows, FEATURES, "RandomForest", {"numTrees": 3})
    sinks.save_model(model, f"{tmp_path}/m")
    sinks.save_model(model, f"{tmp_path}/m")
    again = sinks.load_model(f"{tmp_path}/m")
    assert rows_of(models.score(model, split_rows), "r", "score") == rows_of(models.score(again, split_rows), "r", "score")


def test_importances_follow_the_assembler(split_rows):
    model = models.refit(split_rows, FEATURES, "RandomForest", {"numTrees": 5})
    ranked = models.top_features(models.importances(model), 2).collect()
    assert [r.feature for r in ranked][0] == "ndvi_med" and len(ranked) == 2


def test_incomplete_rows_are_skipped_and_counted(spark, split_rows):
    model = models.refit(split_rows, FEATURES, "RandomForest", {"numTrees": 2})
    holed = split_rows.limit(100).withColumn("ndvi_med", F.when(F.col("r") % 10 != 0, F.col("ndvi_med")))
    assert models.score(model, holed).count() == holed.where("ndvi_med IS NOT NULL").count()


def test_vote_and_threshold(spark):
    scores = spark.createDataFrame([(1, 0.9, 0.3), (2, 0.2, 0.1), (3, None, 0.8), (4, None, None)], "id int, a double, b double")
    voted = scores.withColumns(models.mean_vote(["a", "b"], 0.5))
    assert rows_of(voted, "id", "prediction") == {(1, 1.0), (2, 0.0), (3, 1.0), (4, None)}


def test_vote_keeps_incomplete_rows(split_rows):
    fitted = [models.refit(split_rows, FEATURES, "RandomForest", {"numTrees": n}) for n in (2, 3)]
    holed = split_rows.limit(100).withColumn("ndvi_med", F.when(F.col("r") % 10 != 0, F.col("ndvi_med"))).cache()
    voted = models.vote(fitted, holed).cache()
    assert voted.count() == holed.count()
    assert voted.where("score IS NULL AND prediction IS NULL").count() == holed.where("ndvi_med IS NULL").count()


def test_training_run_evaluation_and_prediction(spark, table, tmp_path):
    grids = {"RandomForest": {"numTrees": [4], "maxDepth": [4]}, "GBT": {"maxIter": [3], "maxDepth": [3]}}
    result = jobs.train_models(table, KEYS, grids)
    metrics = result["metrics"]
    n_test = result["rows"].where("split = 'test'").count()
    assert sum(metrics[k] for k in ("tn", "fp", "fn", "tp")) == n_test and result["n_skipped"] == 0
    jobs.save_run(spark, result, f"{tmp_path}/run")
    board = jobs.leaderboard(spark, f"{tmp_path}/*/metrics/summary").collect()
    assert [b.winner for b in board] == [result["winner"]]
    again = jobs.evaluate_model(spark, f"{tmp_path}/run/pipeline_best", result["rows"], f"{tmp_path}/eval")
    assert again["metrics"]["roc_auc"] == pytest.approx(metrics["roc_auc"])
    assert "| counts | tp |" in again["report"] and "ndvi_med" in again["report"]
    assert spark.read.text(f"{tmp_path}/eval/report").count() > 20
    out = jobs.predict_zones(result["model"], table, f"{tmp_path}/scored", threshold=0.9)
    assert spark.read.parquet(f"{tmp_path}/scored").count() == 1200
    assert out.where("prediction = 1 AND score < 0.9").count() == 0


def test_build_training_from_pixels(spark, sf_dir):
    px = land.reflectances(spark, sf_dir)
    extent = staging.stage(land.zone_extent(spark, sf_dir), "extent")
    edges = polygon_edges(land.vertices(spark, sf_dir, extent))
    masked = jobs.build_training(px, edges, extent)
    plain = jobs.build_training(px, edges, extent, use_masks=False)
    assert rows_of(masked, *KEYS) <= rows_of(plain, *KEYS)
    assert {r[0] for r in rows_of(plain, "label")} <= {0, 1}


# contract --------------------------------------------------------------------------

def test_entry_and_model_queries(spark, sf_dir):
    assert entry.entry(spark).columns[:3] == ["zone", "r", "c"]
    registered = entry.queries()
    without_sql = set(registered) - set(entry.oracle_sql())
    for name in ("rf_predictions", "predict_zone", "top_features", "vote_ensemble"):
        assert name in without_sql and registered[name](spark, sf_dir).count() > 0


def test_reprojection_query_has_every_zone(spark, sf_dir):
    out = entry.queries()["reproject_bilinear"](spark, sf_dir)
    assert out.select("zone").distinct().count() == 5
    assert out.where("b04 < 0 OR b04 > 1").count() == 0
