"""De-duplication, normalisation, imputation, capping and range filters of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from acreage.constants import LATITUDE_RANGE, LONGITUDE_RANGE
from acreage.functions import scalar as X
from acreage.operators.joins import lookup_join
from acreage.operators.quantiles import approximate_quantiles, exact_quantiles, group_medians

CAPPED_COLUMNS = ["PRICE", "PROPERTYSQFT", "BEDS", "BATH"]


def near_duplicate_key() -> list[Column]:
    return [X.coordinate_key(F.col("LATITUDE")), X.coordinate_key(F.col("LONGITUDE")), F.col("PRICE")]


def deduplicate(df: DataFrame, order: list[str]) -> DataFrame:
    """First row in `order` of every group with equal rounded position and price; nulls are equal.

    Exact copies share that key, so one shuffle removes both. Spark limits each group to its
    first row before the shuffle, hence a hot key sends one row per task.
    """
    first = Window.partitionBy(*near_duplicate_key()).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") == 1).drop("_nth")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def normalize_text_columns(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: X.clean_text(F.col(f"`{c}`")) for c in text})


def _on_column(df: DataFrame, column: str, fn) -> DataFrame:
    return df.withColumn(column, fn(F.col(column))) if column in df.columns else df


def normalize_borough(df: DataFrame, column: str = "BOROUGH") -> DataFrame:
    return _on_column(df, column, X.borough_name)


def normalize_zipcode(df: DataFrame, column: str = "ZIPCODE") -> DataFrame:
    return _on_column(df, column, X.zipcode)


def normalize_type(df: DataFrame, column: str = "TYPE") -> DataFrame:
    return _on_column(df, column, X.property_type)


def impute_missing(df: DataFrame, group: str = "BOROUGH", rows: int | None = None) -> DataFrame:
    """Rooms get the median of their group, then the median of the filled column; size the median."""
    rooms = [c for c in ("BEDS", "BATH") if c in df.columns]
    filled = df
    if rooms and group in df.columns:
        medians = group_medians(df, group, rooms).groupBy(group).agg(*[
            F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_median_{c}") for c in rooms
        ])
        filled = lookup_join(df, medians, [group]).withColumns({
            c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}")) for c in rooms
        }).select(*df.columns)
    columns = [*rooms, *(["PROPERTYSQFT"] if "PROPERTYSQFT" in df.columns else [])]
    if not columns:
        return filled
    fallback = exact_quantiles(filled, columns, [0.5], rows)
    return filled.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(fallback[c][0])) for c in columns
    })


def cap_outliers(
    df: DataFrame, columns: list[str] | None = None, factor: float = 3.0, exact: bool = True,
    rows: int | None = None,
) -> DataFrame:
    """Clip to the quartiles widened by `factor` times their distance; null stays null."""
    present = [c for c in columns or CAPPED_COLUMNS if c in df.columns]
    wanted = [0.25, 0.75]
    quartiles = exact_quantiles(df, present, wanted, rows) if exact else approximate_quantiles(df, present, wanted)
    capped = {}
    for c, (q1, q3) in quartiles.items():
        if q1 is not None:
            reach = factor * (q3 - q1)
            capped[c] = X.clip(F.col(c).cast("double"), q1 - reach, q3 + reach)
    return df.withColumns(capped)


def positive_price_and_size(df: DataFrame) -> DataFrame:
    return df.filter((F.col("PRICE") > 0) & (F.col("PROPERTYSQFT") > 0))


def inside_city(df: DataFrame) -> DataFrame:
    return df.filter(
        F.col("LATITUDE").between(*LATITUDE_RANGE) & F.col("LONGITUDE").between(*LONGITUDE_RANGE)
    )
