"""Declared schemas of the canonical tables."""

from __future__ import annotations

from pyspark.sql import types as T

LISTINGS = T.StructType([
    T.StructField("PRICE", T.DoubleType()),
    T.StructField("BEDS", T.DoubleType()),
    T.StructField("BATH", T.DoubleType()),
    T.StructField("PROPERTYSQFT", T.DoubleType()),
    T.StructField("LATITUDE", T.DoubleType()),
    T.StructField("LONGITUDE", T.DoubleType()),
    T.StructField("BOROUGH", T.StringType()),
    T.StructField("TYPE", T.StringType()),
    T.StructField("SUBLOCALITY", T.StringType()),
    T.StructField("ZIPCODE", T.StringType()),
    T.StructField("PROPERTY_CATEGORY", T.StringType()),
    T.StructField("BROKERTITLE", T.StringType()),
    T.StructField("ADDRESS", T.StringType()),
])

REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("beds", T.IntegerType()),
    T.StructField("bath", T.DoubleType()),
    T.StructField("propertysqft", T.DoubleType()),
    T.StructField("borough", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("zipcode", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("sublocality", T.StringType()),
])

ROLLING_SALES = T.StructType([
    T.StructField("SALE PRICE", T.StringType()),
    T.StructField("GROSS SQUARE FEET", T.StringType()),
    T.StructField("LAND SQUARE FEET", T.StringType()),
    T.StructField("BOROUGH", T.StringType()),
    T.StructField("BUILDING CLASS CATEGORY", T.StringType()),
    T.StructField("YEAR BUILT", T.StringType()),
    T.StructField("ZIP CODE", T.StringType()),
])

# Column types that a reader may apply by name to any listings export.
LISTING_TYPES = {field.name: field.dataType for field in LISTINGS}
