"""Derived features, targets and category capping for listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from acreage.constants import (
    ALL_FEATURES, ONEHOT_FEATURES, PRICE_ZONE_EDGES, PRICE_ZONES, REFERENCE_POINTS,
    SQFT_CATEGORIES, SQFT_EDGES, TARGET_ENCODED_FEATURES,
)
from acreage.functions import geo, scalar as X
from acreage.operators.guards import assert_no_leakage


def normalize_names(df: DataFrame, upper: bool = True) -> DataFrame:
    """Trim column names and, for listings, put them in upper case."""
    names = [c.strip().upper() if upper else c.strip() for c in df.columns]
    return df.toDF(*names)


def add_default_columns(df: DataFrame) -> DataFrame:
    """Add the categorical columns a listings export may lack."""
    defaults = {}
    if "BOROUGH" not in df.columns:
        known = "SUBLOCALITY" in df.columns
        defaults["BOROUGH"] = F.col("SUBLOCALITY") if known else F.lit("unknown")
    for name, value in {"PROPERTY_CATEGORY": "residential", "SUBLOCALITY": "unknown"}.items():
        if name not in df.columns:
            defaults[name] = F.lit(value)
    return df.withColumns(defaults)


def numeric_feature_columns() -> dict:
    beds, bath, size = F.col("BEDS"), F.col("BATH"), F.col("PROPERTYSQFT")
    rooms = beds + bath
    return {
        "TOTAL_ROOMS": rooms,
        "BED_BATH_RATIO": beds / X.clip(bath, low=F.lit(1.0)),
        "LOG_SQFT": F.log1p(size),
        "ROOMS_PER_SQFT": rooms / X.clip(size, low=F.lit(1.0)),
    }


def add_numeric_features(df: DataFrame) -> DataFrame:
    return df.withColumns(numeric_feature_columns())


def distance_columns(points: dict | None = None, lat: str = "LATITUDE", lon: str = "LONGITUDE") -> dict:
    return {
        "DIST_" + name.upper().replace(" ", "_"): geo.haversine(F.col(lat), F.col(lon), *point)
        for name, point in (points or REFERENCE_POINTS).items()
    }


def add_distance_features(
    df: DataFrame, points: dict | None = None, lat: str = "LATITUDE", lon: str = "LONGITUDE"
) -> DataFrame:
    return df.withColumns(distance_columns(points, lat, lon))


def add_subway_proxy(df: DataFrame) -> DataFrame:
    """Stand-in for the station distance when no stations are given."""
    return df.withColumn("DIST_NEAREST_SUBWAY", F.col("DIST_MANHATTAN_CENTER"))


def add_hex_index(
    df: DataFrame, edge_km: float = 1.2, lat: str = "LATITUDE", lon: str = "LONGITUDE", name: str = "HEX_CELL"
) -> DataFrame:
    return df.withColumn(name, geo.hex_cell(F.col(lat), F.col(lon), edge_km))


def add_target_variables(df: DataFrame) -> DataFrame:
    zone = X.cut(F.col("PRICE"), PRICE_ZONE_EDGES, PRICE_ZONES)
    return df.withColumns({
        "PRICE_ZONE": zone,
        "LOG_PRICE": F.log1p("PRICE"),
        "SQFT_CATEGORY": X.cut(F.col("PROPERTYSQFT"), SQFT_EDGES, SQFT_CATEGORIES),
    })


def add_zone_code(df: DataFrame) -> DataFrame:
    """Zone code in price order, Low 0 to Very High 3."""
    return df.withColumn("ZONE_CODE", X.ordinal(F.col("PRICE_ZONE"), PRICE_ZONES))


def top_values(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """`(feature, value, n)` of the n most frequent values per column; ties go to the smaller value.

    Each task keeps only n values per column before the final choice.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ]))
    counts = (
        df.select(pairs.alias("_pair")).select("_pair.*").filter(F.col("value").isNotNull())
        .groupBy("feature", "value").agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
    return counts.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= n).drop("_nth")


def cap_categorical_cardinality(df: DataFrame, columns: list[str], max_categories: int = 50) -> DataFrame:
    """Keep the most frequent values of each column; the rest and null become `other`."""
    present = [c for c in columns if c in df.columns]
    kept: dict[str, list[str]] = {c: [] for c in present}
    # at most max_categories rows per column
    for row in top_values(df, present, max_categories).collect():
        kept[row["feature"]].append(row["value"])
    return df.withColumns({
        c: F.when(F.col(c).cast("string").isin(kept[c]), F.col(c).cast("string")).otherwise(F.lit("other"))
        for c in present
    })


def canonicalize_categories(df: DataFrame) -> DataFrame:
    present = [c for c in ONEHOT_FEATURES + TARGET_ENCODED_FEATURES if c in df.columns]
    return df.withColumns({c: X.canonical_category(F.col(c)) for c in present})


def drop_missing_targets(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["PRICE_ZONE", "LOG_PRICE"])


def model_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The model's features that exist, after the leakage check, beside the columns in `keep`."""
    features = [c for c in ALL_FEATURES if c in df.columns]
    assert_no_leakage(features)
    return df.select(*(keep or []), *features)
