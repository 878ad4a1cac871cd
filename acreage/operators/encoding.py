"""Scaling and smoothed target encoding as plain aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from acreage.constants import SEED
from acreage.operators.joins import lookup_join
from acreage.session import keep

SMOOTHING = 10.0
MIN_SAMPLES_LEAF = 20


def fit_scaler(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column; a constant column scales by one."""
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns) if row[f"m{i}"] is not None}


def scaled(column: str, mean: float, deviation: float) -> Column:
    return (F.col(column) - F.lit(mean)) / F.lit(deviation)


def standardize(df: DataFrame, columns: list[str], prefix: str = "z_") -> DataFrame:
    fitted = fit_scaler(df, columns)
    return df.withColumns({prefix + c: scaled(c, *fitted[c]) for c in columns if c in fitted})


def target_encodings(
    df: DataFrame, columns: list[str], target: str, method: str = "sigmoid",
    smoothing: float = SMOOTHING, min_samples_leaf: int = MIN_SAMPLES_LEAF,
) -> tuple[DataFrame, float | None]:
    """`(feature, category, n, encoded)` and the prior, the mean of the target.

    `sigmoid` weighs a category by 1 / (1 + exp(-(n - leaf) / smoothing)), `m_estimate` by
    n / (n + smoothing). One aggregation serves all columns.
    """
    y = F.col(target).cast("double")
    prior = df.agg(F.avg(y)).first()[0]
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns
    ]))
    groups = (
        df.select(y.alias("_y"), pairs.alias("_p")).select("_y", "_p.*")
        .filter(F.col("category").isNotNull() & F.col("_y").isNotNull())
        .groupBy("feature", "category").agg(F.count("*").alias("n"), F.avg("_y").alias("_mean"))
    )
    if method == "sigmoid":
        weight = F.lit(1.0) / (F.lit(1.0) + F.exp((F.lit(float(min_samples_leaf)) - F.col("n")) / F.lit(smoothing)))
    else:
        weight = F.col("n") / (F.col("n") + F.lit(smoothing))
    encoded = weight * F.col("_mean") + (F.lit(1.0) - weight) * F.lit(prior)
    return groups.select("feature", "category", "n", encoded.alias("encoded")), prior


def apply_target_encodings(
    df: DataFrame, encodings: DataFrame, prior: float, columns: list[str], suffix: str = "_TE"
) -> DataFrame:
    """Add the encoded value of each column; unseen and null categories get the prior."""
    out, encodings = df, keep(encodings)
    for c in columns:
        table = encodings.filter(F.col("feature") == c).select(
            F.col("category").alias(f"_key_{c}"), F.col("encoded").alias(f"_enc_{c}")
        )
        keyed = out.withColumn(f"_key_{c}", F.col(c).cast("string"))
        out = lookup_join(keyed, table, [f"_key_{c}"]).withColumn(
            c + suffix, F.coalesce(F.col(f"_enc_{c}"), F.lit(prior))
        ).drop(f"_key_{c}", f"_enc_{c}")
    return out


def ordered_target_statistics(
    df: DataFrame, key: str, columns: list[str], target: str, strength: float = 1.0, seed: int = SEED, suffix: str = "_OTS",
) -> DataFrame:
    """Add to each row, per column, the mean target of the rows of its category that stand before it in digest order,
    drawn towards the prior (the mean of all targets) by `strength` rows of it; no row sees its own target.

    A null category has the prior, a null target is not counted but its row has a value. `key` must be unique.
    Sums per category and digest slot give what stands before a slot, so a category that holds most rows is spread
    over 65,536 slots and only a slot's rows are sorted.
    """
    y = F.col(target).cast("double")
    prior = F.lit(df.agg(F.avg(y)).first()[0]).cast("double")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    names = df.columns
    out = df
    for c in columns:
        hashed = out.withColumns({"_category": F.col(c).cast("string"), "_digest": digest, "_y": y}).withColumn(
            "_slot", F.substring("_digest", 1, 4))
        known = hashed.filter(F.col("_category").isNotNull())
        upto = Window.partitionBy("_category").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        before = (
            known.groupBy("_category", "_slot").agg(F.count("_y").alias("_n"), F.coalesce(F.sum("_y"), F.lit(0.0)).alias("_sum"))
            .select("_category", "_slot", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n_before"),
                    F.coalesce(F.sum("_sum").over(upto), F.lit(0.0)).alias("_sum_before"))
        )
        inside = Window.partitionBy("_category", "_slot").orderBy("_digest", key).rowsBetween(Window.unboundedPreceding, -1)
        n = F.col("_n_before") + F.count("_y").over(inside)
        total = F.col("_sum_before") + F.coalesce(F.sum("_y").over(inside), F.lit(0.0))
        found = known.join(before, ["_category", "_slot"]).withColumn(c + suffix, (total + F.lit(strength) * prior) / (n + F.lit(strength)))
        lost = hashed.filter(F.col("_category").isNull()).withColumn(c + suffix, prior)
        kept = [*names, c + suffix]
        out, names = found.select(*kept).unionByName(lost.select(*kept)), kept
    return out


def label_codes(df: DataFrame, label: str) -> DataFrame:
    """Alphabetical code per distinct label; meant for class labels, which are few."""
    labels = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct()
    known = labels.agg(F.array_sort(F.collect_set("label")).alias("labels"))
    return known.select(F.posexplode("labels").alias("code", "label"))
