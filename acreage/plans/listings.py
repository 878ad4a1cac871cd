"""Cleaning and feature jobs over listings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from acreage.ml.clusters import add_neighborhood_clusters
from acreage.operators import cleaning as C, features as P
from acreage.operators.guards import assert_no_leakage
from acreage.operators.spatial import nearest_station_distance
from acreage.session import stage

CAPPED_CATEGORIES = ["SUBLOCALITY", "TYPE", "ZIPCODE"]
TARGET_COLUMNS = {"PRICE", "LOG_PRICE", "PRICE_ZONE", "SQFT_CATEGORY"}


def clean_listings(df: DataFrame, order: list[str]) -> DataFrame:
    """De-duplicate, normalise, impute, cap, then filter.

    The statistics must see the rows that the filters drop later, so the filters come last. The
    de-duplicated rows are written once, since each statistic reads only its own columns of them.
    """
    unique = (
        C.deduplicate(df, order)
        .transform(C.normalize_text_columns).transform(C.normalize_borough)
        .transform(C.normalize_zipcode).transform(C.normalize_type)
    )
    staged = stage(unique, "listings")
    rows = staged.count()
    return (
        staged.transform(C.impute_missing, rows=rows).transform(C.cap_outliers, rows=rows)
        .transform(C.positive_price_and_size).transform(C.inside_city)
    )


def add_geospatial_features(
    df: DataFrame, stations: DataFrame | None = None, clusters: int | None = 15
) -> DataFrame:
    out = P.add_distance_features(df)
    out = nearest_station_distance(out, stations) if stations is not None else P.add_subway_proxy(out)
    out = P.add_hex_index(out)
    return add_neighborhood_clusters(out, clusters) if clusters else out


def feature_pipeline(
    df: DataFrame, stations: DataFrame | None = None, clusters: int | None = 15, keys: list[str] | None = None
) -> DataFrame:
    """All derived features, targets and capped categories, checked for leaks.

    `clusters=None` leaves the clustering out.
    """
    out = add_geospatial_features(P.add_numeric_features(df), stations, clusters)
    out = P.cap_categorical_cardinality(P.add_target_variables(out), CAPPED_CATEGORIES)
    assert_no_leakage([c for c in out.columns if c not in TARGET_COLUMNS | set(keys or [])])
    return out


def prepare_training_data(df: DataFrame, clusters: int | None = 15) -> DataFrame:
    """The training chain: it starts from cleaned listings and uses neither stations nor hexagons."""
    out = P.add_default_columns(P.normalize_names(df))
    out = P.add_subway_proxy(P.add_distance_features(P.add_numeric_features(out)))
    if clusters:
        out = add_neighborhood_clusters(out, clusters)
    out = P.cap_categorical_cardinality(P.add_target_variables(out), CAPPED_CATEGORIES)
    return P.add_zone_code(P.drop_missing_targets(P.canonicalize_categories(out)))
