"""The training job: prepare, split, train, tune, explain, save."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from acreage.constants import NUMERIC_FEATURES, PRICE_ZONES, ALL_FEATURES
from acreage.functions.scalar import thresholded_argmax
from acreage.ml import training as T
from acreage.ml.attributions import is_tree_model, tree_attributions
from acreage.operators import explain, metrics as E, monitoring as M, thresholds as H
from acreage.operators.features import model_features
from acreage.operators.ranking import stratified_split
from acreage.plans.listings import prepare_training_data
from acreage.session import stage
from acreage.sources.files import log_metrics, save_baseline

LABELS = ["PRICE_ZONE", T.LABEL, T.TARGET]


@dataclass(frozen=True)
class Effort:
    """Model sizes; the defaults are the published ones."""

    trees: int = 500
    forest_depth: int = 20
    rounds: int = 500
    booster_depth: int = 6
    booster_leaves: int = 63
    clusters: int | None = 15
    network: bool = True
    network_iterations: int = 80
    explained_rows: int = 200
    permutations: int = 16
    trials: int = 0  # of the parameter search; 0 trains without one
    folds: int = 5


def training_table(cleaned: DataFrame, key: str, clusters: int | None = 15) -> DataFrame:
    """Model features, labels and the split of cleaned listings, written once."""
    prepared = prepare_training_data(cleaned, clusters)
    return stage(
        stratified_split(model_features(prepared, [key, *LABELS]), key, "PRICE_ZONE"), "training")


def zone_score(model, label: int):
    """Scoring function of the probability of one zone, for explanations."""

    def score(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("score", F.get(T.probabilities(), F.lit(label)))

    return score


def explain_zones(test: DataFrame, key: str, features: list[str], model, label: int, effort: Effort) -> DataFrame:
    """`(row_id, feature, value)` of one zone: exact for models of trees, sampled for others."""
    if not isinstance(model, PipelineModel) or not is_tree_model(model.stages[-1]):
        return explain.shapley_values(
            test, key, features, zone_score(model, label), effort.explained_rows, permutations=effort.permutations)
    values, _ = tree_attributions(test, key, model, features, effort.explained_rows)
    return values.filter(F.col("output") == label).drop("output")


def run_training(
    cleaned: DataFrame, key: str, folder: str, run: str = "run", effort: Effort = Effort()
) -> dict[str, DataFrame]:
    """Train classifiers and regressors, keep the best of each under `folder`, and return the tables.

    Thresholds are tuned on a validation part of the training rows, so the test rows stay unseen.
    """
    spark = cleaned.sparkSession
    key = key.upper()
    rows = training_table(cleaned, key, effort.clusters)
    rows = stage(T.add_class_weights(rows), "weighted")
    train, test = rows.filter("split = 'train'").drop("split"), rows.filter("split = 'test'").drop("split")

    zones = {
        "random_forest": T.zone_pipeline(T.zone_forest(effort.trees, effort.forest_depth)),
        "booster": T.zone_pipeline(T.zone_booster(effort.rounds, effort.booster_depth)),
        "weighted_booster": T.zone_pipeline(T.zone_booster(effort.rounds, effort.booster_depth, weight=T.WEIGHT)),
        "leaf_booster": T.zone_pipeline(T.zone_booster(effort.rounds, leaves=effort.booster_leaves, weight=T.WEIGHT)),
        "ordered_booster": T.ordered_zone_pipeline(T.zone_booster(effort.rounds, effort.booster_depth, weight=T.WEIGHT), key),
    }
    if effort.network:
        zones["network"] = T.joint_pipeline(steps=effort.network_iterations)
    prices = {
        "random_forest": T.price_pipeline(T.price_forest(effort.trees, effort.forest_depth)),
        "booster": T.price_pipeline(T.price_booster(effort.rounds, effort.booster_depth)),
        "leaf_booster": T.price_pipeline(T.price_booster(effort.rounds, leaves=effort.booster_leaves)),
        "line": T.price_pipeline(T.price_line()),
    }
    chosen: dict[str, dict] = {}
    if effort.trials:
        plain = train.drop("fold") if "fold" in train.columns else train
        _, chosen["zone_tuned_booster"], _ = T.tune_classifier(plain, key, effort.trials, effort.folds)
        _, chosen["price_tuned_booster"], _ = T.tune_regressor(plain, key, effort.trials, effort.folds)
        zones["tuned_booster"] = T.zone_pipeline(T.tuned(T.zone_booster(), chosen["zone_tuned_booster"]))
        prices["tuned_booster"] = T.price_pipeline(T.tuned(T.price_booster(), chosen["price_tuned_booster"]))
    classified = T.train_classifiers(train, test, zones)
    regressed = T.train_regressors(train, test, prices)
    T.save_model(regressed.best_model, f"{folder}/price_regressor_best")
    for prefix, trained in (("zone", classified), ("price", regressed)):
        for r in trained.metrics.collect():
            values = r.asDict()
            model = values.pop("model")
            values.pop("position")
            used = {**asdict(effort), **chosen.get(f"{prefix}_{model}", {})}
            log_metrics(spark, f"{folder}/metrics", run, f"{prefix}_{model}", values, used)

    parts = stratified_split(train, key, "PRICE_ZONE", seed=7)
    fitted = zones[classified.best].fit(parts.filter("split = 'train'"))
    held = fitted.transform(parts.filter("split = 'test'")).select(
        T.LABEL, T.probabilities().alias("probability"))
    tuned = H.optimize_thresholds(stage(held, "validation"), "probability", T.LABEL, PRICE_ZONES)
    cuts = [r["threshold"] for r in tuned.orderBy("position").collect()]
    T.save_model(classified.best_model, f"{folder}/price_zone_best", cuts)
    judged = classified.best_model.transform(test).withColumn(
        "TUNED_PRED", thresholded_argmax(T.probabilities(), cuts))

    features = [c for c in ALL_FEATURES if c in test.columns]
    attributions = explain_zones(test, key, features, classified.best_model, len(PRICE_ZONES) - 1, effort)
    baseline = M.feature_stats(train, NUMERIC_FEATURES)
    save_baseline(baseline, f"{folder}/drift_baseline")
    return {
        "classifiers": classified.metrics, "regressors": regressed.metrics,
        "fairness": classified.extra["fairness"], "thresholds": tuned,
        "tuned_metrics": E.evaluate_classifier(judged, T.LABEL, "TUNED_PRED"),
        "importance": explain.global_importance(attributions), "baseline": baseline,
    }
