"""Profiles, validation counts, drift and prediction health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from acreage.constants import LATITUDE_RANGE, LONGITUDE_RANGE, PRICE_ZONES, REQUIRED_COLUMNS
from acreage.functions import scalar as X
from acreage.operators.guards import DriftError, HealthError
from acreage.operators.quantiles import approximate_quantiles, exact_quantiles

DRIFT_THRESHOLD = 0.15
SMALL_STD = 1e-8


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def feature_stats(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """One row per numeric column with any value: mean, sample std, min, max, quartiles, count."""
    columns = columns or numeric_columns(df)
    quantiles = (exact_quantiles if exact else approximate_quantiles)(df, columns, [0.25, 0.5, 0.75])
    parts = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        low, mid, high = (F.lit(q).cast("double") for q in quantiles[c])
        parts.append(F.struct(
            F.lit(c).alias("feature"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max"), low.alias("p25"), mid.alias("p50"),
            high.alias("p75"), F.count(v).alias("count"),
        ).alias(f"s{i}"))
    row = df.agg(*parts)
    return (
        row.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(columns))])).alias("_s"))
        .select("_s.*").filter(F.col("count") > 0)
    )


def detect_drift(
    current: DataFrame, baseline: DataFrame, threshold: float = DRIFT_THRESHOLD, columns: list[str] | None = None
) -> DataFrame:
    """Features whose mean moved by more than `threshold` baseline standard deviations.

    `baseline` is a `feature_stats` table; features absent on either side are skipped.
    """
    names = columns or numeric_columns(current)
    means = current.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(names)])
    now = means.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("current_mean")) for i, c in enumerate(names)
    ])).alias("_m")).select("_m.*").filter(F.col("current_mean").isNotNull())
    return drift_rows(now, baseline, threshold)


def shift_ratio() -> Column:
    scale = F.when(F.col("baseline_std") < SMALL_STD, F.lit(1.0)).otherwise(F.col("baseline_std"))
    return F.abs(F.col("current_mean") - F.col("baseline_mean")) / scale


def drift_rows(now: DataFrame, baseline: DataFrame, threshold: float) -> DataFrame:
    base = baseline.select(
        "feature", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std")
    )
    shift = F.bround(shift_ratio(), 4)
    return (
        now.join(base, "feature").filter(shift_ratio() > threshold)
        .select(*now.columns, "baseline_mean", shift.alias("shift_ratio"))
    )


def check_drift(
    current: DataFrame, baseline: DataFrame, threshold: float = DRIFT_THRESHOLD, fail_on_drift: bool = False
) -> DataFrame:
    drifted = detect_drift(current, baseline, threshold)
    if fail_on_drift:
        names = [r["feature"] for r in drifted.orderBy("feature").collect()]
        if names:
            raise DriftError(f"drift in {len(names)} features: {names}")
    return drifted


def windowed_means(events: DataFrame, time: str, columns: list[str], width: str) -> DataFrame:
    """Mean and count per feature and tumbling window; the same on a table and on a stream."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns
    ]))
    return (
        events.select(time, pairs.alias("_p")).select(time, "_p.*").filter(F.col("value").isNotNull())
        .groupBy(F.window(time, width).alias("_w"), "feature")
        .agg(F.avg("value").alias("current_mean"), F.count("*").alias("n"))
        .select(F.col("_w.start").alias("window_start"), "feature", "current_mean", "n")
    )


def windowed_drift(
    events: DataFrame, baseline: DataFrame, time: str, columns: list[str],
    width: str = "1 day", threshold: float = DRIFT_THRESHOLD,
) -> DataFrame:
    """Shift of every window against the baseline, with the verdict `drifted`."""
    # one row per listed column
    base = F.broadcast(baseline.filter(F.col("feature").isin(columns)).select(
        "feature", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std")
    ))
    joined = windowed_means(events, time, columns, width).join(base, "feature")
    return joined.select(
        "window_start", "feature", "n", "current_mean", shift_ratio().alias("shift"),
        F.coalesce(shift_ratio() > threshold, F.lit(False)).alias("drifted"),
    )


def validation_issues(df: DataFrame) -> DataFrame:
    """Violations of the cleaned-listing rules as `(check, column, n)`; no rows when clean."""
    tests: list[tuple[str, str, Column]] = []
    for c in ("PRICE", "BEDS", "BATH", "PROPERTYSQFT"):
        tests.append(("null", c, F.col(f"`{c}`").isNull()))
    for c in ("PRICE", "PROPERTYSQFT"):
        tests.append(("non_positive", c, F.col(c) <= 0))
    for c, bounds in (("LATITUDE", LATITUDE_RANGE), ("LONGITUDE", LONGITUDE_RANGE)):
        tests.append(("out_of_range", c, ~F.coalesce(F.col(c).between(*bounds), F.lit(False))))
    tests = [t for t in tests if t[1] in df.columns]
    absent = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(t).alias(f"n{i}") for i, (_, _, t) in enumerate(tests)])
    rows = [
        F.struct(F.lit(kind).alias("check"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n"))
        for i, (kind, c, _) in enumerate(tests)
    ] + [
        F.struct(F.lit("missing_column").alias("check"), F.lit(c).alias("column"), F.lit(1).cast("long").alias("n"))
        for c in absent
    ]
    return counts.select(F.explode(F.array(*rows)).alias("_i")).select("_i.*").filter(F.col("n") > 0)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, nulls, distinct values, smallest and largest value of any column, as text.

    Values are reduced to distinct pairs before they are counted, so no task holds a value set.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ]))
    counts = df.select(cells.alias("_c")).select("_c.*").groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("nulls"),
        F.count("value").alias("distinct_values"),
        F.min("value").alias("smallest"),
        F.max("value").alias("largest"),
    )


def cleaning_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after cleaning and the rows dropped."""
    raw = before.agg(F.count("*").alias("n")).scalar()
    return after.agg(F.count("*").alias("n_clean")).select(
        raw.alias("n_raw"), "n_clean", (raw - F.col("n_clean")).alias("n_dropped")
    )


def zone_share(df: DataFrame, by: list[str] | None = None, zone: str = "PRICE_ZONE") -> DataFrame:
    """Rows and percentage per price zone, in zone order, within each group."""
    by = by or []
    counts = df.filter(F.col(zone).isNotNull()).groupBy(*by, zone).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return (
        counts.withColumn("pct", F.col("n") * 100 / F.sum("n").over(whole))
        .orderBy(*by, X.ordinal(F.col(zone), PRICE_ZONES))
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the extremes; the last bin includes the maximum."""
    value = F.col(column).cast("double")
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        low = high = 0.0
    width = (high - low) or 1.0
    index = F.floor((value - F.lit(low)) * F.lit(float(bins)) / F.lit(width))
    bucket = F.when(index >= bins, F.lit(bins - 1)).otherwise(index).cast("int")
    return df.filter(value.isNotNull()).groupBy(bucket.alias("bin")).agg(F.count("*").alias("n"))


def prediction_health(
    df: DataFrame, prediction: str, n_min: int = 500, max_identical_share: float = 0.95
) -> DataFrame:
    """One row of counts with the first failing check, in the order few, nan, inf, collapse."""
    value = F.col(prediction).cast("double")
    counts = df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    bad = F.col("value").isNull() | F.isnan("value")
    finite = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("n_nan"),
        F.coalesce(F.sum(F.when(X.is_infinite(F.col("value")), F.col("n"))), F.lit(0)).alias("n_inf"),
        F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("dominant_value"),
        F.max("n").alias("_most"),
    )
    share = F.try_divide(F.col("_most"), F.col("n"))
    failure = (
        F.when(F.col("n") < n_min, F.lit("insufficient predictions"))
        .when(F.col("n_nan") > 0, F.lit("nan predictions"))
        .when(F.col("n_inf") > 0, F.lit("inf predictions"))
        .when(share > max_identical_share, F.lit("prediction collapse"))
    )
    return finite.select(
        "n", "n_nan", "n_inf", "dominant_value", share.alias("dominant_share"), failure.alias("failure"),
        F.when(failure.isNull(), F.lit("passed")).otherwise(F.lit("failed")).alias("status"),
    )


def check_predictions_healthy(df: DataFrame, prediction: str, **limits) -> None:
    row = prediction_health(df, prediction, **limits).first()
    if row["failure"]:
        raise HealthError(f"{row['failure']}: {row.asDict()}")
