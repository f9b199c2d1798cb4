"""End-to-end jobs: scenes to training tables, training, evaluation, batch prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracover.operators import models
from terracover.operators.composite import temporal_composite, valid_observations
from terracover.operators.dataset import feature_columns, join_labels
from terracover.operators.joins import lookup_join
from terracover.operators.labels import label_grid
from terracover.operators.masks import clear_mask, masked_by_cell, masked_observations
from terracover.operators.metrics import evaluation
from terracover.operators.polygons import clip_to_layer
from terracover.operators.report import evaluation_report
from terracover.operators.splits import hash_split
from terracover.operators.weights import add_class_weight
from terracover.plans.zones import ZoneRun
from terracover.sources import sinks, store
from terracover.sources.staging import stage


def build_training(px: DataFrame, edges: DataFrame, extent: DataFrame, erosion_px: int = 1,
                   use_masks: bool | None = None) -> DataFrame:
    """Training rows of every zone at once: composite, label grid, join.

    Masks apply by default when the pixels carry a scene class; ``False`` leaves them out.
    """
    masked = "scl" in px.columns if use_masks is None else use_masks
    looks = masked_observations(px, clear_mask(px)) if masked else px
    composite = temporal_composite(valid_observations(looks), at_most=px)
    return join_labels(composite, label_grid(edges, extent, erosion_px))


def clip_stored(spark: SparkSession, path: str, edges: DataFrame, extent: DataFrame, layer: str = "perimeter") -> DataFrame:
    """Pixels of sorted files (see ``sources.store``) inside a layer; row groups outside its bounds are skipped."""
    wanted = stage(edges.where(F.col("layer") == layer), "layer")
    near = store.within(spark.read.parquet(path), store.layer_bounds(wanted, extent))
    return clip_to_layer(near, wanted, extent, layer)


def zone_steps(run: ZoneRun, px: DataFrame, edges: DataFrame, extent: DataFrame, erosion_px: int = 1, use_masks: bool = False) -> dict:
    """Steps of a committed run over zones: composite, labels without ignored cells, and their union.

    Each takes its pending zones and works on these alone; the union reads what the two
    before it have committed.
    """
    of = lambda df, zones: lookup_join(df, zones, "zone", "left_semi")

    def features(zones: DataFrame) -> DataFrame:
        looks = of(px, zones)
        looks = masked_observations(looks, clear_mask(looks)) if use_masks else looks
        return temporal_composite(valid_observations(looks), at_most=px)

    def labels(zones: DataFrame) -> DataFrame:
        grid = stage(of(extent, zones), "zone_extent")
        return label_grid(of(edges, zones), grid, erosion_px).where("label <> -1")

    def union(zones: DataFrame) -> DataFrame:
        return join_labels(run.output("03_features", zones), run.output("04_labels", zones))

    return {"03_features": features, "04_labels": labels, "05_union": union}


def stored_training(obs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows from buckets of observations and labels (see ``sources.store``): no exchange."""
    return join_labels(temporal_composite(obs, together=True), labels)


def stored_masked_composite(px: DataFrame, scenes: DataFrame) -> DataFrame:
    """Masked composite from buckets of pixels and of their clear scenes: no exchange."""
    clear = valid_observations(masked_by_cell(px, scenes))
    return temporal_composite(clear, at_most=px, together=True)


def train_models(
    table: DataFrame, keys=("zone", "r", "c"), grids: dict | None = None, metric: str = "areaUnderPR",
    test: float = 0.15, seed: int = 42, weights_from: str = "train", parallelism: int = 8,
) -> dict:
    """Tune both families, choose on the validation rows, evaluate on the test rows.

    A search ends with a fit of its best point on all training rows; the winner's is the model.
    The split is stored as a column, so a later evaluation sees the same test rows.
    ``weights_from="all"`` takes class shares from all rows instead of the training rows.
    """
    grids = grids or {"RandomForest": models.RF_GRID, "GBT": models.GBT_GRID}
    features = feature_columns(table)
    rows = stage(hash_split(table.where(F.col("label").isNotNull()), keys, test, test, seed), "split")
    fit_on = rows if weights_from == "all" else rows.where("split = 'train'")
    rows = add_class_weight(rows, fit_on=fit_on)
    train = rows.where("split = 'train'").persist()
    val, held = rows.where("split = 'val'"), rows.where("split = 'test'")
    column = {"areaUnderPR": "area_under_pr", "areaUnderROC": "roc_auc"}[metric]
    try:
        found, fitted = {}, {}
        for family, grid in grids.items():
            model, params, inner = models.tune(
                train, features, family, grid, metric, parallelism=parallelism, seed=seed
            )
            fitted[family] = model
            found[family] = {
                "params": params,
                "inner": inner,
                "val": evaluation(models.score(model, val)).first().asDict(),
                "test": evaluation(models.score(model, held)).first().asDict(),
            }
        winner = models.choose({name: f["val"][column] for name, f in found.items()})
    finally:
        train.unpersist()
    final = fitted[winner]
    return {
        "winner": winner, "model": final, "families": found, "features": features, "rows": rows,
        "n_skipped": held.count() - models.score(final, held).count(),
        "metrics": found[winner]["test"],
    }


def fixed_forest(table: DataFrame, features=None, **overrides):
    """The fixed forest on the training rows of a table with ``split`` and ``class_weight``."""
    params = {**models.RF_FIXED, **overrides}
    return models.refit(
        table.where("split = 'train'"), features or feature_columns(table), "RandomForest", params
    )


def summary_row(spark: SparkSession, result: dict, metric: str = "areaUnderPR") -> DataFrame:
    """One-row run summary for the JSON sink and the leaderboard."""
    metrics = result["metrics"]
    names = ["accuracy", "roc_auc", "area_under_pr", "average_precision", "weighted_f1", "f1_1"]
    cells = {k: metrics[k] for k in ("tn", "fp", "fn", "tp")}
    params = {k: str(v) for k, v in result["families"][result["winner"]]["params"].items()}
    row = (
        metric, result["winner"], len(result["features"]), {k: float(metrics[k]) for k in names}, cells, params,
    )
    schema = (
        "metric_used string, winner string, n_features int, test_metrics map<string,double>, "
        "confusion_matrix map<string,bigint>, best_params map<string,string>"
    )
    return spark.createDataFrame([row], schema)


def save_run(spark: SparkSession, result: dict, out: str) -> None:
    """Model, summary JSON, importances CSV."""
    sinks.save_model(result["model"], f"{out}/pipeline_best")
    sinks.write_json(summary_row(spark, result), f"{out}/metrics/summary")
    ranked = models.importances(result["model"]).orderBy(F.col("importance").desc())
    sinks.write_table(ranked.coalesce(1), f"{out}/metrics/feature_importances", "csv")


def leaderboard(spark: SparkSession, glob: str) -> DataFrame:
    """Saved run summaries ordered by ROC AUC."""
    schema = "winner string, n_features int, test_metrics map<string,double>"
    return (
        spark.read.schema(schema).json(glob)
        .select(
            F.input_file_name().alias("path"), "winner", "n_features",
            *(F.col("test_metrics")[m].alias(m) for m in ("accuracy", "weighted_f1", "roc_auc")),
        )
        .orderBy(F.col("roc_auc").desc())
    )


def evaluate_model(spark: SparkSession, model_path: str, table: DataFrame, out: str) -> dict:
    """Score the stored test rows with a saved model; write metrics, importances and report."""
    model = sinks.load_model(model_path)
    held = table.where("split = 'test'") if "split" in table.columns else table
    metrics = evaluation(models.score(model, held))
    ranked = models.importances(model).orderBy(F.col("importance").desc(), "feature")
    sinks.write_json(metrics, f"{out}/metrics")
    sinks.write_json(ranked, f"{out}/feature_importance")
    stored = spark.read.json(f"{out}/metrics")
    report = evaluation_report(stored, ranked, type(model.stages[-1]).__name__)
    sinks.write_text(spark, report, f"{out}/report")
    return {"metrics": stored.first().asDict(), "report": report}


def predict_zones(model, features: DataFrame, out: str | None = None, threshold: float = 0.5,
                  fmt: str = "parquet") -> DataFrame:
    """Class-1 score and thresholded prediction of every pixel, written by zone if asked.

    Pixels with a missing feature stay, with NULL score and prediction.
    """
    scored = models.score_all(model, features).select(
        "zone", "r", "c", "score", (F.col("score") >= threshold).cast("double").alias("prediction")
    )
    if out is not None:
        sinks.write_zones(scored, out, fmt)
    return scored
