"""Operators against brute force on small fixtures, and skewed paths against plain ones."""

import itertools
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracover.operators import dataset, metrics, regrid, splits, weights
from terracover.operators.composite import min_support, temporal_composite, valid_observations
from terracover.operators.joins import lookup_join, stored_size
from terracover.operators.labels import label_grid
from terracover.operators.masks import clear_mask, scene_thresholds
from terracover.operators.morphology import dilate, dilate_flags, erode
from terracover.operators.polygons import grid_cells, polygon_cells, polygon_edges
from terracover.operators.quantiles import group_quantiles
from terracover.operators.ranking import running_totals
from terracover.sources.staging import stage


def rows_of(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


@pytest.fixture(scope="module")
def looks(spark):
    rng = random.Random(3)
    rows = []
    for pixel, n in ((0, 1), (1, 2), (2, 7), (3, 300)):
        for _ in range(n):
            value = None if rng.random() < 0.1 else round(rng.random(), 3)
            rows.append((pixel, value, rng.choice([0.25, 0.5, float("nan")])))
    return spark.createDataFrame(rows, "pixel int, v double, w double"), rows


WANTED = {"v_med": ("v", "median", 0.5), "v_p10": ("v", "nearest", 0.1), "v_lin": ("v", "linear", 0.8),
          "w_med": ("w", "median", 0.5)}


def test_group_quantiles_match_numpy(looks):
    df, rows = looks
    got = {r["pixel"]: r for r in group_quantiles(df, ["pixel"], WANTED).collect()}
    for pixel in got:
        v = sorted(r[1] for r in rows if r[0] == pixel and r[1] is not None)
        assert got[pixel]["n_obs"] == sum(r[0] == pixel for r in rows)
        if v:
            assert got[pixel]["v_med"] == pytest.approx(statistics.median(v))
            assert got[pixel]["v_p10"] == v[int((len(v) - 1) * 0.1 + 0.5)]
            assert got[pixel]["v_lin"] == pytest.approx(np.quantile(v, 0.8))


def test_hot_group_path_equals_plain_path(looks):
    """Pixel 3 holds most rows; with small limits it is sliced, and nothing changes."""
    df, _ = looks
    key = lambda out: sorted((tuple(None if x is None else round(x, 12) for x in r) for r in out.collect()), key=repr)
    assert key(group_quantiles(df, ["pixel"], WANTED)) == key(group_quantiles(df, ["pixel"], WANTED, limit=5))


def test_running_totals_sliced_equals_window(spark):
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.8 else 1, i, rng.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, k int, n bigint")
    for keys, descending in ((["g"], False), (["g"], True), ([], True)):
        plain = running_totals(df, keys, "k", ["n"], descending)
        sliced = running_totals(df, keys, "k", ["n"], descending, limit=50)
        columns = ["g", "k", "cum_n", "total_n"]
        assert rows_of(plain, *columns) == rows_of(sliced, *columns)


def test_lookup_join_measures_texts(spark):
    big = spark.range(50).selectExpr("id", "id % 5 AS k")
    short = stage(spark.range(5).selectExpr("id AS k", "CAST(id AS STRING) AS name"), "short")
    long = stage(spark.range(5).selectExpr("id AS k", "repeat('x', 20 * 1024 * 1024) AS name"), "long")
    assert stored_size(short) == (5, 5 * 25) and stored_size(long) == (5, 5 * (24 + 20 * 1024 * 1024))
    assert stored_size(short.selectExpr("array(name) AS a"))[1] > 5 * 16
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(lookup_join(big, short, "k"))
    assert "SortMergeJoin" in plan(lookup_join(big, long, "k"))


def test_lookup_join_same_rows_beyond_the_bound(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 7)
    small = spark.createDataFrame([(k, k * 10) for k in range(5)], "k bigint, v bigint")
    few, none = lookup_join(big, small, "k"), lookup_join(big, small, "k", max_rows=0)
    assert rows_of(few, "id", "v") == rows_of(none, "id", "v")


def test_nodata_is_judged_on_the_first_band(spark):
    px = spark.createDataFrame([(0.0, 0.9), (0.1, 0.0)], "b02 double, b03 double")
    assert rows_of(valid_observations(px), "b02") == {(0.1,)}
    flagged = px.withColumn("valid", F.col("b03") > 0)
    assert rows_of(valid_observations(flagged), "b02") == {(0.0,)}


def test_composite_order_of_statistics(spark):
    rng = random.Random(1)
    rows = [(0, i % 5, i % 3, rng.random(), rng.uniform(-1, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "zone int, r int, c int, b02 double, ndvi double")
    out = temporal_composite(df).collect()
    assert sum(r["n_obs"] for r in out) == 400
    assert all(r["ndvi_p10"] <= r["ndvi_med"] <= r["ndvi_p90"] for r in out)
    assert all(r["ndvi_range"] == r["ndvi_p90"] - r["ndvi_p10"] for r in out)


def test_min_support(spark):
    df = spark.createDataFrame([(z, i, 0, n) for z in (0, 1) for i, n in enumerate((1, 3, 5))],
                               "zone int, r int, c int, n_obs int").union(
        spark.createDataFrame([(1, 9, 9, 4)], "zone int, r int, c int, n_obs int"))
    assert rows_of(min_support(df, 3, 3), "zone", "r") == {(1, 1), (1, 2), (1, 9)}


# masks -----------------------------------------------------------------------------

def brute_mask(cells, radius=1):
    """Array version of the mask rules on one scene: cells {(r, c): (scl, ndvi, nir)}."""
    clear = {k: v[0] not in (3, 8, 9, 10, 11) for k, v in cells.items()}
    if any(clear.values()):
        bright = np.percentile([cells[k][2] for k in cells if clear[k]], 80)
        for k, (_, ndvi, nir) in cells.items():
            clear[k] = clear[k] and not (ndvi < 0.10 and nir > bright)
    if any(clear.values()):
        dark = np.percentile([cells[k][2] for k in cells if clear[k]], 20)
        for k, (_, ndvi, nir) in cells.items():
            clear[k] = clear[k] and not (ndvi < 0.05 and nir < dark)
    bad = [k for k in cells if not clear[k]]
    near = lambda a, b: abs(a[0] - b[0]) + abs(a[1] - b[1]) <= radius
    return {(*k, int(not any(near(k, b) for b in bad))) for k in cells}


@pytest.mark.parametrize("limit", [100_000, 20])
def test_clear_mask_matches_arrays(spark, limit):
    rng = random.Random(11)
    scenes = {
        s: {(r, c): (rng.choice([4, 4, 4, 4, 5, 6, 8]), rng.uniform(-0.3, 0.9), round(rng.random(), 2))
            for r in range(12) for c in range(12)}
        for s in (1, 2)
    }
    rows = [(0, s, r, c, *v) for s, cells in scenes.items() for (r, c), v in cells.items()]
    px = spark.createDataFrame(rows, "zone int, scene int, r int, c int, scl int, ndvi double, b8a double")
    got = clear_mask(px, limit=limit)
    for s, cells in scenes.items():
        assert rows_of(got.where(F.col("scene") == s), "r", "c", "clear") == brute_mask(cells)


def test_scene_without_clear_pixels(spark):
    px = spark.createDataFrame([(0, 1, 0, c, 8, 0.5, 0.5) for c in range(4)],
                               "zone int, scene int, r int, c int, scl int, ndvi double, b8a double")
    assert scene_thresholds(px).count() == 0
    assert rows_of(clear_mask(px), "clear") == {(0,)}


def test_pixel_at_the_threshold_stays_clear(spark):
    px = spark.createDataFrame([(0, 1, 0, 10 * c, 4, 0.0, 0.5) for c in range(5)],
                               "zone int, scene int, r int, c int, scl int, ndvi double, b8a double")
    assert rows_of(clear_mask(px), "clear") == {(1,)}


# morphology ------------------------------------------------------------------------

def random_cells(seed, size=10, share=0.6):
    rng = random.Random(seed)
    return {(r, c) for r in range(size) for c in range(size) if rng.random() < share}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_erosion_and_dilation_equal_repeated_cross(spark, radius):
    cells = random_cells(radius)
    cross = [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)]
    eroded, dilated = set(cells), set(cells)
    for _ in range(radius):
        eroded = {(r, c) for r, c in eroded if all((r + a, c + b) in eroded for a, b in cross)}
        dilated = {(r + a, c + b) for r, c in dilated for a, b in cross}
    df = spark.createDataFrame([(0, r, c) for r, c in cells], "zone int, r int, c int")
    assert rows_of(erode(df, ["zone"], radius), "r", "c") == eroded
    assert rows_of(dilate(df, ["zone"], radius), "r", "c") == dilated


def test_full_grid_loses_its_border_ring(spark):
    df = spark.createDataFrame([(0, r, c) for r in range(5) for c in range(5)], "zone int, r int, c int")
    assert rows_of(erode(df, ["zone"]), "r", "c") == {(r, c) for r in range(1, 4) for c in range(1, 4)}


def test_single_bad_pixel_grows_to_thirteen(spark):
    df = spark.createDataFrame([(0, r, c, int((r, c) == (5, 5))) for r in range(11) for c in range(11)],
                               "zone int, r int, c int, bad int")
    assert dilate_flags(df, ["zone"], "bad", 2).where("bad = 1").count() == 13
    assert dilate_flags(df, ["zone"], "bad", 0).where("bad = 1").count() == 1


# polygons --------------------------------------------------------------------------

def inside(ring, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


RINGS = {
    ("forest", 1): [(1.2, 1.1), (9.3, 0.4), (11.7, 12.9), (6.1, 5.2), (2.4, 10.8)],
    ("forest", 2): [(8.1, 8.2), (17.3, 7.7), (16.9, 14.4)],
    ("perimeter", 3): [(-3.2, -2.3), (14.1, -1.7), (23.8, 9.2), (4.7, 22.4)],
}


@pytest.fixture(scope="module")
def parcels(spark):
    rows = [(7, layer, poly, i, x, y) for (layer, poly), ring in RINGS.items() for i, (x, y) in enumerate(ring)]
    vertices = spark.createDataFrame(rows, "zone int, layer string, poly_id int, seq int, x double, y double")
    extent = spark.createDataFrame([(7, 14, 18)], "zone int, height int, width int")
    return polygon_edges(vertices), extent


def covered(layer):
    rings = [ring for (name, _), ring in RINGS.items() if name == layer]
    return {(r, c) for r in range(14) for c in range(18) if any(inside(g, c + 0.5, r + 0.5) for g in rings)}


@pytest.mark.parametrize("layer", ["forest", "perimeter"])
def test_scanline_fill_equals_point_in_polygon(parcels, layer):
    cells = polygon_cells(*parcels).where(F.col("layer") == layer)
    assert rows_of(cells, "r", "c") == covered(layer)


@pytest.mark.parametrize("erosion, perimeter", [(0, True), (1, True), (2, False)])
def test_label_grid_composition(parcels, erosion, perimeter):
    forest, farm = covered("forest"), covered("perimeter")
    for _ in range(erosion):
        forest = {(r, c) for r, c in forest
                  if {(r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)} <= forest}
    want = {
        (r, c, -1 if perimeter and (r, c) not in farm else int((r, c) in forest))
        for r in range(14) for c in range(18)
    }
    assert rows_of(label_grid(*parcels, erosion, perimeter), "r", "c", "label") == want


def test_grid_cells(spark):
    extent = spark.createDataFrame([(0, 2, 3), (1, 1, 1)], "zone int, height int, width int")
    assert grid_cells(extent).count() == 7


# training tables -------------------------------------------------------------------

def test_label_join_modes(spark):
    labels = spark.createDataFrame([(0, r, c, int(c == 1)) for r in range(2) for c in range(2)],
                                   "zone int, r int, c int, label int")
    extent = spark.createDataFrame([(0, 2, 2)], "zone int, height int, width int")
    px = spark.createDataFrame([(0, 0, 0), (0, 1, 1), (0, 1, 9)], "zone int, r int, c int")
    assert rows_of(dataset.join_labels(px, labels), "c", "label") == {(0, 0), (1, 1)}
    kept = dataset.join_labels(px, labels, exclude_ignored=False)
    assert rows_of(kept, "c", "label") == {(0, 0), (1, 1), (9, -1)}
    clamped = dataset.join_labels(px, labels, extent, mode="clamp")
    assert rows_of(clamped, "c", "label") == {(0, 0), (1, 1), (9, 1)}


def test_zone_stats_of_published_counts(spark):
    zones = {"14": (20, 412), "29": (1104, 3202), "32": (644, 854), "35": (50, 221), "79": (2, 1499)}
    df = spark.createDataFrame([(z, l) for z, n in zones.items() for l, k in ((1, n[0]), (0, n[1])) for _ in range(k)],
                               "zone string, label int")
    stats = {r["zone"]: r for r in dataset.zone_stats(df).collect()}
    assert (stats[None]["n_total"], stats[None]["n_forest"]) == (8008, 1820)
    assert stats["79"]["ratio"] == 749.5


def test_zone_without_forest_has_ratio_zero(spark):
    stats = dataset.zone_stats(spark.createDataFrame([("a", 0), ("b", 1)], "zone string, label int")).where("zone = 'a'")
    assert tuple(stats.select("ratio", "pct_forest").first()) == (0.0, 0.0)


def test_consolidate_fills_and_widens(spark):
    a = spark.createDataFrame([(1, 2.0)], "label int, v double")
    b = spark.createDataFrame([(0, 5)], "label bigint, n bigint")
    out = dataset.consolidate({"a": a, "b": b})
    assert rows_of(out, "zone", "label", "v", "n") == {("a", 1, 2.0, None), ("b", 0, None, 5)}
    with pytest.raises(ValueError):
        dataset.consolidate({})


def test_feature_columns_keep_every_numeric_type(spark):
    df = spark.createDataFrame([(0, 1, 1.0, 2, 0, "s")], "zone int, label int, ndvi double, n_obs bigint, k smallint, s string")
    assert dataset.feature_columns(df) == ["ndvi", "n_obs", "k"]


def test_dataset_checks(spark):
    df = spark.createDataFrame([(i % 2, 1.0 if i else None, "train" if i % 4 < 2 else "test") for i in range(100)],
                               "label int, f double, split string")
    row = dataset.dataset_checks(df, ["f"], min_rows=99).first()
    assert (row.enough_rows, row.balanced, row.complete, row.binary_labels, row.similar_split) == (True, True, False, True, True)


# splits and weights ----------------------------------------------------------------

def test_published_stratified_sizes(spark):
    df = spark.range(8008).select("id", (F.col("id") < 1820).cast("int").alias("label"))
    out = splits.stratified_split(df, "label", ["id"])
    n = {(r["split"], r["label"]): r["count"] for r in out.groupBy("split", "label").count().collect()}
    assert (n["test", 0], n["test", 1], n["val", 0], n["val", 1]) == (929, 273, 926, 272)
    assert out.count() == out.select("id").distinct().count() == 8008


def test_rank_slots_with_shared_buckets(spark, monkeypatch):
    """With 16 buckets most rows share one, and the cut falls inside a bucket."""
    df = spark.range(500).select("id", F.lit(1).alias("g"))
    ends = spark.createDataFrame([(1, 137, 300)], "g int, e1 bigint, e2 bigint")
    want = rows_of(splits.rank_slots(df, "g", ["id"], ends, ["e1", "e2"]), "id", "slot")
    monkeypatch.setattr(splits, "BUCKET_DIGITS", 1)
    got = rows_of(splits.rank_slots(df, "g", ["id"], ends, ["e1", "e2"]), "id", "slot")
    assert got == want and sum(s == 0 for _, s in got) == 137 and sum(s == 1 for _, s in got) == 163


def test_splits_do_not_depend_on_layout(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).cast("int").alias("label"))
    for split in (lambda d: splits.hash_split(d, ["id"]), lambda d: splits.stratified_split(d, "label", ["id"])):
        assert rows_of(split(df), "id", "split") == rows_of(split(df.repartition(7)), "id", "split")


def test_resampling_sizes(spark):
    df = spark.range(100).select("id", (F.col("id") < 13).cast("int").alias("label"))
    under = splits.undersample(df, "label", ["id"]).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in under} == {0: 26, 1: 13}
    over = splits.oversample(df, "label", ["id"])
    assert {r["label"]: r["count"] for r in over.groupBy("label").count().collect()} == {0: 87, 1: 44}
    assert over.select("id", "copy").distinct().count() == 131


def test_weights_sum_to_rows(spark):
    df = spark.range(100).select((F.col("id") < 13).cast("int").alias("label"))
    total = weights.add_class_weight(df).agg(F.sum("class_weight")).first()[0]
    assert total == pytest.approx(100)
    other = weights.add_class_weight(spark.createDataFrame([(5,)], "label int"), fit_on=df)
    assert other.first()["class_weight"] == 1.0


# metrics ---------------------------------------------------------------------------

def test_published_confusion(spark):
    cells = {(0, 0): 836, (0, 1): 93, (1, 0): 23, (1, 1): 250}
    df = spark.createDataFrame([k for k, n in cells.items() for _ in range(n)], "label int, prediction int")
    confusion = metrics.confusion_matrix(df)
    assert tuple(confusion.first()) == (836, 93, 23, 250)
    positive = metrics.class_metrics(confusion).where("class = 1").first()
    # Published to two decimals of a percent: 72.89, 91.58, 81.17 and 90.35.
    assert positive.precision == pytest.approx(250 / 343)
    assert positive.recall == pytest.approx(250 / 273)
    assert positive.f1 == pytest.approx(500 / 616)
    accuracy = metrics.weighted_metrics(confusion).first().accuracy
    published = [round(100 * v, 2) for v in (positive.precision, positive.recall, positive.f1, accuracy)]
    assert published == [72.89, 91.58, 81.17, 90.35]


def test_areas_match_pairs_and_spark_evaluators(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(2)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos, neg = [s for l, s in rows if l], [s for l, s in rows if not l]
    auc = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    for limit in (100_000, 10):
        got = metrics.threshold_areas(metrics.score_totals(df, limit=limit)).first()
        assert got.roc_auc == pytest.approx(auc)
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
        assert got.roc_auc == pytest.approx(evaluator.evaluate(df), abs=1e-9)
        evaluator.setMetricName("areaUnderPR")
        assert got.area_under_pr == pytest.approx(evaluator.evaluate(df), abs=1e-9)


def test_metrics_of_one_class_are_zero_not_errors(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (0, 1, 0.7)], "label int, prediction int, score double")
    row = metrics.evaluation(df).first()
    assert (row.roc_auc, row.average_precision, row.precision_1, row.recall_1) == (0.0, 0.0, 0.0, 0.0)


def test_evaluation_equals_the_separate_operators(spark):
    rng = random.Random(9)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double").withColumn("prediction", (F.col("score") > 0.6).cast("double"))
    row = metrics.evaluation(df).first()
    confusion = metrics.confusion_matrix(df)
    assert tuple(row[c] for c in ("tn", "fp", "fn", "tp")) == tuple(confusion.first())
    assert row.weighted_f1 == pytest.approx(metrics.weighted_metrics(confusion).first().weighted_f1)
    areas = metrics.threshold_areas(metrics.score_totals(df)).first()
    assert (row.roc_auc, row.average_precision) == pytest.approx((areas.roc_auc, areas.average_precision))


# resampling ------------------------------------------------------------------------

def test_bilinear_reproduces_a_plane(spark):
    extent = spark.createDataFrame([(0, 12, 8)], "zone int, height int, width int")
    source = grid_cells(extent).withColumn("v", F.col("r") * 2.0 + F.col("c") * 3.0)
    targets = regrid.scaled_targets(extent, 3, 4)
    joined = regrid.bilinear(targets, source, ["zone"], ["v"]).join(targets, ["zone", "r", "c"]).collect()
    assert len(joined) == 54
    for t in joined:
        assert t.v == pytest.approx(2.0 * (t.src_r - 0.5) + 3.0 * (t.src_c - 0.5))


def test_reprojected_grid_covers_the_scene(spark):
    scene = spark.createDataFrame([(0, 20, 30, 18, False, 480000.0, 600000.0, 20.0)],
                                  "zone int, height int, width int, utm_zone int, south boolean, "
                                  "east0 double, north0 double, pixel double")
    grid = regrid.geographic_grid(scene, ["zone"])
    row = grid.first()
    assert abs(row.t_height - 20) <= 1 and abs(row.t_width - 30) <= 1
    targets = regrid.reprojected_targets(grid, ["zone"])
    span = targets.agg(F.min("src_r"), F.max("src_r"), F.min("src_c"), F.max("src_c")).first()
    assert -1 < span[0] < 1.5 and 18.5 < span[1] < 21 and -1 < span[2] < 1.5 and 28.5 < span[3] < 31
    source = grid_cells(scene.select("zone", "height", "width")).withColumn("v", F.lit(0.25))
    out = regrid.bilinear(targets, source, ["zone"], ["v"]).agg(F.min("v"), F.max("v")).first()
    assert out[0] == pytest.approx(0.25) and out[1] == pytest.approx(0.25)
