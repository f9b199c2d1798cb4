"""Group size, NULL keys and NULL labels change no result."""

import pytest
from pyspark.sql import functions as F

from terracover.functions.hashing import key_digest
from terracover.operators import models
from terracover.operators.quantiles import group_quantiles
from terracover.operators.splits import oversample, stratified_split, undersample

WANTED = {"mid": ("x", "median", 0.5), "low": ("x", "nearest", 0.1), "lin": ("y", "linear", 0.8)}


@pytest.fixture(scope="module")
def readings(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 17 != 0, F.col("id") % 40).alias("k"),
        ((F.hash("id") % 1000) / 700).cast("float").alias("x"), (F.col("id") * 1.1).cast("float").alias("y"),
    )
    holes = F.when(F.col("x") > 1.3, F.lit(float("nan"))).when(F.col("x") < -1.3, None).otherwise(F.col("x")).cast("float")
    return df.withColumn("x", holes).cache()


@pytest.mark.parametrize("limit", [1, 5, 71, 176, 100_000])
def test_quantiles_do_not_depend_on_the_limit(readings, limit):
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows(group_quantiles(readings, ["k"], WANTED, limit=limit)) == rows(group_quantiles(readings, ["k"], WANTED))


def test_null_labels_are_a_class(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 5 != 0, (F.col("id") % 3 == 0).cast("int")).alias("label"))
    split = stratified_split(df, "label", ["id"])
    assert split.count() == 400 and split.where("label IS NULL").count() == 80
    assert split.where("label IS NULL AND split = 'test'").count() in (12, 13)
    assert undersample(df, "label", ["id"]).where("label IS NULL").count() == 80
    assert oversample(df, "label", ["id"]).where("label IS NULL").count() == 107


@pytest.mark.parametrize("family,size", [("RandomForest", {"numTrees": 4}), ("GBT", {"maxIter": 2})])
def test_fits_do_not_depend_on_the_layout(spark, family, size):
    rows = spark.range(600).select(
        (F.col("id") % 3).alias("zone"), F.floor(F.col("id") / 30).alias("r"), (F.col("id") % 30).alias("c"),
        (F.hash("id") % 100).cast("double").alias("f1"), (F.hash(F.col("id") + 1) % 100).cast("double").alias("f2"),
    ).withColumn("label", (F.col("f1") + F.col("f2") > 0).cast("int")).withColumn("class_weight", F.lit(1.0))
    seen = []
    for layout in (rows.repartition(4), rows.repartition(7, "f1")):
        model, params, metric = models.tune(layout, ["f1", "f2"], family, {"maxDepth": [2, 3]}, folds=3, **size)
        again = models.refit(layout, ["f1", "f2"], family, params, **size)
        seen.append([(params, round(metric, 9))] + sorted(tuple(r) for m in (model, again) for r in models.score(m, rows).select("r", "c", "score").collect()))
    assert seen[0] == seen[1]


def test_null_keys_have_their_own_digest(spark):
    df = spark.createDataFrame([("1", None, "2"), ("1", "2", None)], "a string, b string, c string")
    assert df.select(key_digest(1, "a", "b", "c")).distinct().count() == 2


def test_requested_statistics(spark):
    from terracover.operators.composite import requested_stats

    obs = spark.createDataFrame([(1, 1.0), (1, 3.0), (1, None), (1, float("nan")), (None, 5.0)], "k int, x double")
    rows = {r.k: r for r in requested_stats(obs, {"x": ("mean", "median", "p100", "min")}, ["k"]).collect()}
    assert (rows[1].x_mean, rows[1].x_median, rows[1].x_p100, rows[1].x_min, rows[1].n_obs) == (2.0, 2.0, 3.0, 1.0, 4)
    assert (rows[None].x_mean, rows[None].x_median) == (5.0, 5.0)
    with pytest.raises(ValueError):
        requested_stats(obs, {"x": ("mode",)}, ["k"])


def test_zone_run_stops_at_the_first_empty_step(spark):
    from terracover.operators.quality import run_report, zone_run

    zones = lambda *z: spark.createDataFrame([(x,) for x in z], "zone int")
    log = zone_run(zones(1, 2, 3, 4), {"03_features": zones(1, 1, 2, 3), "04_labels": zones(1, 3), "05_union": zones(1)})
    got = {r.zone: (r.status, r.failed_step, r.n_features) for r in log.collect()}
    assert got == {1: ("success", None, 2), 2: ("error", "04_labels", 1), 3: ("error", "05_union", 1), 4: ("error", "03_features", 0)}
    total = run_report(log).where("zone IS NULL").first()
    assert (total.n_runs, total.n_success, total.n_error, total.first_failed_step) == (4, 1, 3, "03_features")


def test_unreadable_zones_are_recorded(spark, tmp_path):
    from terracover.sources.readers import read_zones, zone_status

    root = str(tmp_path / "zones")
    spark.range(30).select((F.col("id") % 3).alias("zone"), "id").repartition(1).write.partitionBy("zone").parquet(root)
    spark.range(5).repartition(1).write.mode("append").parquet(f"{root}/zone=2")
    broken = sorted((tmp_path / "zones" / "zone=2").glob("*.parquet"))[0]
    for path in (broken, *(tmp_path / "zones" / "zone=1").glob("*.parquet")):
        path.write_bytes(b"no parquet")
        (path.parent / f".{path.name}.crc").unlink()
    got = {r.zone: (r.n_files, r.n_unreadable, r.status) for r in zone_status(spark, root).collect()}
    assert got == {"0": (1, 0, "ok"), "1": (1, 1, "unreadable"), "2": (2, 1, "partial")}
    assert read_zones(spark, root, tolerant=True).where("zone = 1").isEmpty()
