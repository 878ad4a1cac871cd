"""Mapping of raw sales to model features under an ordered, audited drop engine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from acreage.functions import scalar as X

MAPPED_FEATURES = ["borough_name", "land_sqft", "property_sqft", "property_type", "year_built", "zip_code"]


@dataclass(frozen=True)
class SalesColumns:
    """Physical names of the raw sales columns."""

    price: str = "SALE PRICE"
    gross: str = "GROSS SQUARE FEET"
    land: str = "LAND SQUARE FEET"
    borough: str = "BOROUGH"
    category: str = "BUILDING CLASS CATEGORY"
    year: str = "YEAR BUILT"
    zipcode: str = "ZIP CODE"


UNDERSCORED = SalesColumns(*[name.replace(" ", "_") for name in vars(SalesColumns()).values()])


def _parsed(df: DataFrame, names: SalesColumns) -> DataFrame:
    """Add the raw columns as numbers for rules and features.

    The numbers come out of a generator, through which no filter is pushed; otherwise the parsing
    would be repeated in the filter for every mention of a number.
    """

    def number(name: str) -> Column:
        return X.coerce_number(F.col(f"`{name}`"), df.schema[name].dataType)

    numbers = {f"_{k}": number(v) for k, v in vars(names).items() if k != "category"}
    category = F.coalesce(X.strip(F.col(f"`{names.category}`")), F.lit("nan"))
    parsed = {**numbers, "_category": category}
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in parsed.items()]))))


def _drop_reason() -> Column:
    """Name of the first rule that rejects a parsed row, null when it is kept.

    A comparison with a missing number rejects nothing; a missing class is not residential.
    """
    price = F.col("_price")
    rules = [
        ("sale_price_non_positive", price <= 0),
        ("sale_price_out_of_range", (price < 10_000) | (price > 100_000_000)),
        ("missing_gross_sqft", F.col("_gross") == 0),
        ("missing_year_built", F.col("_year") == 0),
        ("non_residential_class", ~F.col("_category").startswith("R")),
    ]
    reason = F.when(F.lit(False), F.lit(None))
    for name, rejected in rules:
        reason = reason.when(F.coalesce(rejected, F.lit(False)), F.lit(name))
    return reason


def run_drop_engine(df: DataFrame, names: SalesColumns = SalesColumns()) -> DataFrame:
    """Add `drop_reason`, the first rule that rejects a row."""
    return _parsed(df, names).withColumn("drop_reason", _drop_reason()).select(*[
        F.col(f"`{c}`") for c in df.columns], "drop_reason")


def drop_reason_counts(dropped: DataFrame) -> DataFrame:
    return (
        dropped.filter(F.col("drop_reason").isNotNull())
        .groupBy("drop_reason").agg(F.count("*").alias("n"))
    )


def mapping_report(dropped: DataFrame) -> DataFrame:
    """One row: n_raw, n_dropped, n_scored and the count per reason, from one aggregation."""
    counts = dropped.groupBy("drop_reason").agg(F.count("*").alias("n"))
    is_drop = F.col("drop_reason").isNotNull()
    total = F.coalesce(F.sum("n"), F.lit(0))
    gone = F.coalesce(F.sum(F.when(is_drop, F.col("n"))), F.lit(0))
    # one entry per rule
    entries = F.collect_list(F.when(is_drop, F.struct("drop_reason", "n")))
    return counts.agg(
        total.alias("n_raw"), gone.alias("n_dropped"), (total - gone).alias("n_scored"),
        F.map_from_entries(entries).alias("drop_reasons"),
    )


def _mapped(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """The six model features and the log target, row by row, beside the columns in `keep`."""

    def whole(name: str) -> Column:
        return F.col(name).try_cast("long")

    return parsed.select(
        *keep,
        X.borough_from_code(whole("_borough")).alias("borough_name"),
        whole("_land").alias("land_sqft"),
        whole("_gross").alias("property_sqft"),
        F.substring("_category", 1, 2).alias("property_type"),
        whole("_year").alias("year_built"),
        whole("_zipcode").alias("zip_code"),
        F.log1p("_price").alias("TARGET"),
    )


def apply_schema_map(
    raw: DataFrame, keep: list[str], names: SalesColumns = SalesColumns()
) -> tuple[DataFrame, DataFrame]:
    """Mapped rows with their target, and the report; both read one scan of `raw`."""
    trimmed = raw.toDF(*[c.strip() for c in raw.columns])
    parsed = _parsed(trimmed, names).withColumn("drop_reason", _drop_reason())
    return _mapped(parsed.filter(F.col("drop_reason").isNull()), keep), mapping_report(parsed)
