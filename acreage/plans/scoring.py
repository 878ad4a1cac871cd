"""Scoring accepted requests with a zone classifier and a price regressor."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from acreage.ml.training import probabilities
from acreage.operators.scoring import price_record, request_features, split_requests, zone_record


def score_features(
    features: DataFrame, classifier: PipelineModel, regressor: PipelineModel, keep: list[str],
    thresholds: list[float] | None = None,
) -> DataFrame:
    """Zone and price records of rows that already carry the model features."""
    scored = regressor.transform(classifier.transform(features))
    return scored.select(
        *keep, zone_record(probabilities(), thresholds=thresholds).alias("zone"),
        price_record(F.col("PRICE_PRED")).alias("price"),
    )


def score_requests(
    requests: DataFrame, classifier: PipelineModel, regressor: PipelineModel, keep: list[str],
    thresholds: list[float] | None = None,
) -> DataFrame:
    return score_features(request_features(requests, keep), classifier, regressor, keep, thresholds)


def score_batch(
    requests: DataFrame, classifier: PipelineModel, regressor: PipelineModel, keep: list[str],
    thresholds: list[float] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scored requests and rejected ones."""
    accepted, rejected = split_requests(requests)
    return score_requests(accepted, classifier, regressor, keep, thresholds), rejected
