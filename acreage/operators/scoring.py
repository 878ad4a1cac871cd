"""Request validation, serving features and prediction records; batch and streaming share them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acreage.constants import LATITUDE_RANGE, LONGITUDE_RANGE, PRICE_ZONES
from acreage.functions import scalar as X
from acreage.operators.features import add_subway_proxy, distance_columns, numeric_feature_columns


def rejected_fields() -> Column:
    """Names of the request fields that are missing or out of range, in declared order."""

    def inside(name: str, low: float, high: float) -> Column:
        return F.col(name).between(low, high)

    valid = {
        "beds": inside("beds", 0, 20),
        "bath": inside("bath", 0, 15),
        "propertysqft": (F.col("propertysqft") > 0) & (F.col("propertysqft") <= 50_000),
        "borough": F.col("borough").isNotNull(),
        "type": F.col("type").isNotNull(),
        "zipcode": F.col("zipcode").rlike(r"^[0-9]{5}\z"),
        "latitude": inside("latitude", *LATITUDE_RANGE),
        "longitude": inside("longitude", *LONGITUDE_RANGE),
    }
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in valid.items()
    ]))


def validate_requests(df: DataFrame) -> DataFrame:
    """Add `rejected`; an empty list means the request is accepted."""
    return df.withColumns({
        "sublocality": F.coalesce(F.col("sublocality"), F.lit("unknown")),
        "rejected": rejected_fields(),
    })


def split_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = validate_requests(df)
    good = F.size("rejected") == 0
    return checked.filter(good).drop("rejected"), checked.filter(~good)


def request_features(df: DataFrame, keep: list[str]) -> DataFrame:
    """Model features of accepted requests, by the training expressions."""
    named = df.select(
        *keep,
        F.col("beds").cast("double").alias("BEDS"),
        F.col("bath").cast("double").alias("BATH"),
        F.col("propertysqft").cast("double").alias("PROPERTYSQFT"),
        F.col("latitude").alias("LATITUDE"),
        F.col("longitude").alias("LONGITUDE"),
        F.lower("borough").alias("BOROUGH"),
        F.lower("type").alias("TYPE"),
        F.lit("residential").alias("PROPERTY_CATEGORY"),
        F.col("zipcode").alias("ZIPCODE"),
        F.lower("sublocality").alias("SUBLOCALITY"),
    )
    return add_subway_proxy(
        named.withColumns({**numeric_feature_columns(), **distance_columns()}).drop("LATITUDE", "LONGITUDE")
    )


def zone_record(probabilities: Column, labels: list[str] = PRICE_ZONES, thresholds: list[float] | None = None) -> Column:
    """Label, confidence and probability per label; the confidence is the plain maximum even
    when thresholds choose the label."""
    index = X.thresholded_argmax(probabilities, thresholds) if thresholds else X.argmax(probabilities)
    names = F.array(*[F.lit(label) for label in labels])
    return F.struct(
        F.get(names, index).alias("price_zone"),
        F.bround(F.array_max(probabilities), 3).alias("confidence"),
        F.map_from_arrays(names, F.transform(probabilities, lambda p: F.bround(p, 3))).alias("probabilities"),
    )


def price_record(log_price: Column) -> Column:
    """Price and its range to the nearest hundred."""
    price = F.expm1(log_price)
    return F.struct(
        X.nearest_hundred(price).alias("predicted_price"),
        F.struct(
            X.nearest_hundred(price * F.lit(0.85)).alias("low"),
            X.nearest_hundred(price * F.lit(1.15)).alias("high"),
        ).alias("price_range"),
    )
