"""Attribution tables `(row_id, feature, value)` and what is read from them."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from acreage.constants import SEED
from acreage.functions.scalar import direction
from acreage.operators.ranking import sample_rows
from acreage.session import stage


def global_importance(attributions: DataFrame, top: int | None = None) -> DataFrame:
    """Mean absolute attribution per feature, over rows and, if present, classes; largest first."""
    ranked = (
        attributions.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))
        .orderBy(F.desc("mean_abs"), "feature")
    )
    return ranked.limit(top) if top else ranked


def top_factors(attributions: DataFrame, n: int = 5) -> DataFrame:
    """The n features that moved each row most, with the direction."""
    order = Window.partitionBy("row_id").orderBy(F.desc(F.abs("value")), "feature")
    return (
        attributions.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
        .select("row_id", "rank", "feature", F.bround("value", 4).alias("value"),
                direction(F.col("value")).alias("direction"))
    )


def linear_attributions(df: DataFrame, key: str, coefficients: dict[str, float]) -> DataFrame:
    """Exact attribution of a linear model: coefficient times distance from the mean."""
    names = list(coefficients)
    means = df.agg(*[F.avg(c) for c in names]).first()
    parts = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 (F.lit(float(coefficients[c])) * (F.col(c) - F.lit(mean))).alias("value"))
        for c, mean in zip(names, means)
    ]))
    return df.select(F.col(key).alias("row_id"), parts.alias("_a")).select("row_id", "_a.*")


def shapley_values(
    df: DataFrame, key: str, features: list[str], score: Callable[[DataFrame], DataFrame],
    max_samples: int = 500, background: int = 100, permutations: int = 16, seed: int = SEED,
) -> DataFrame:
    """Sampled Shapley values of any scoring function as `(row_id, feature, value)`.

    Each sampled row walks through seeded feature orders, taking one more feature from itself and
    the rest from a background row; `score` adds a column `score`. The change at the step of a
    feature, averaged over the orders, is its attribution. The work is
    max_samples * permutations * (features + 1) rows, whatever the size of `df`.
    """
    sampled = stage(sample_rows(df.select(key, *features), key, max_samples, seed), "explained")
    others = sample_rows(df.select(key, *features), key, background, seed + 1)
    numbered = stage(
        others.withColumn("_slot", F.row_number().over(Window.orderBy(key)) - 1)
        .select("_slot", *[F.col(f).alias(f"_bg_{f}") for f in features]), "background",
    )
    size = numbered.count()
    if size == 0:
        return df.sparkSession.createDataFrame([], "row_id long, feature string, value double")
    order = F.transform(
        F.array_sort(F.array(*[
            F.struct(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_perm"), F.lit(f))).alias("h"),
                     F.lit(f).alias("f")) for f in features
        ])), lambda s: s["f"],
    )
    slot = F.pmod(F.xxhash64(F.col(key), F.col("_perm"), F.lit(seed)), F.lit(size)).cast("int")
    walked = (
        sampled.withColumn("_perm", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
        .withColumns({"_slot": slot, "_order": order})
        .join(F.broadcast(numbered), "_slot")
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    )
    mixed = walked.select(
        F.col(key).alias("row_id"), "_perm", "_step", "_order",
        *[F.when(F.array_position("_order", f) <= F.col("_step"), F.col(f))
          .otherwise(F.col(f"_bg_{f}")).alias(f) for f in features],
    )
    walk = Window.partitionBy("row_id", "_perm").orderBy("_step")
    return (
        score(mixed).select("row_id", "_perm", "_step", "_order", "score")
        .withColumn("value", F.col("score") - F.lag("score").over(walk))
        .filter(F.col("_step") > 0)
        .groupBy("row_id", F.element_at("_order", F.col("_step")).alias("feature"))
        .agg(F.avg("value").alias("value"))
    )


def kernel_coalitions(features: int, most: int, seed: int = SEED) -> list[tuple[int, list[float]]]:
    """Coalitions as bit masks, each with what its value adds to the attribution of every feature.

    The attributions are the weighted least-squares fit of the coalition values that adds up to the whole
    change; the normal equations are the same for all rows, so each attribution is a fixed sum over
    coalitions. All coalitions are taken while there are at most `most`; beyond, sizes are drawn by
    their total kernel weight and members evenly, with the complement of each coalition.
    """
    if not 1 <= features <= 62:
        raise ValueError("kernel attributions need 1 to 62 features")
    full = (1 << features) - 1
    sizes = np.arange(1, features)
    weights: dict[int, float] = {}
    if full - 1 <= most:
        for mask in range(1, full):
            size = mask.bit_count()
            weights[mask] = (features - 1) / (math.comb(features, size) * size * (features - size))
    else:
        rng = np.random.default_rng(seed)
        chance = 1 / (sizes * (features - sizes))
        while len(weights) + 2 <= min(full - 1, max(most, 2 * features)):
            size = rng.choice(sizes, p=chance / chance.sum())
            mask = sum(1 << int(j) for j in rng.permutation(features)[:size])
            for one in (mask, full ^ mask):
                weights[one] = weights.get(one, 0.0) + 1.0
    masks = sorted(weights)
    members = np.array([[mask >> j & 1 for j in range(features)] for mask in masks], float).reshape(len(masks), features)
    weighted = members * np.array([weights[m] for m in masks])[:, None]
    # with one feature there is no coalition between none and all, and it takes the whole change
    inverse = np.linalg.pinv(weighted.T @ members) if masks else np.eye(features)
    share = inverse.sum(axis=1) / inverse.sum()
    parts = (inverse - np.outer(share, inverse.sum(axis=0))) @ weighted.T
    inner = [(mask, parts[:, k].tolist()) for k, mask in enumerate(masks)]
    return [(0, (-parts.sum(axis=1) - share).tolist()), *inner, (full, share.tolist())]


def kernel_attributions(
    df: DataFrame, key: str, features: list[str], score: Callable[[DataFrame], DataFrame],
    max_samples: int = 500, background: int = 100, coalitions: int = 2048, seed: int = SEED,
) -> DataFrame:
    """Kernel Shapley values of any scoring function as `(row_id, feature, value)`; exact for the chosen
    background while all coalitions are taken (up to 11 features by default).

    A coalition's value is the mean score over the background rows with the coalition's features taken from
    the explained row; `score` adds a column `score`. The work is max_samples * coalitions * background
    scored rows, whatever the size of `df`; per coalition the scores become one mean before the shuffle. Nulls
    go to `score` as they are; rows that share a key are explained by the mean of their values; an empty
    table gives an empty result.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("_row"), *features)
    explained = stage(sample_rows(rows, "_row", max_samples, seed), "explained")
    others = stage(sample_rows(rows, "_row", background, seed + 1).select(F.struct(*features).alias("_other")), "background")
    table = kernel_coalitions(len(features), coalitions, seed)
    known = spark.createDataFrame([(i, mask, parts) for i, (mask, parts) in enumerate(table)], "_at int, _mask long, _parts array<double>")
    # bounded by `background` rows, which every task gets as one array
    given = others.agg(F.collect_list("_other").alias("_others"))
    dealt = (
        explained.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(len(table) - 1))))
        .repartition("_row", "_at").withColumn("_one", F.lit(1))
        .join(F.broadcast(given.withColumn("_one", F.lit(1))), "_one")
        .join(F.broadcast(known.select("_at", "_mask")), "_at")
        .withColumn("_other", F.explode("_others"))
    )
    mixed = dealt.select("_row", "_at", *[
        F.when(F.shiftright("_mask", j).bitwiseAND(F.lit(1)) == 1, F.col(f)).otherwise(F.col("_other")[f]).alias(f)
        for j, f in enumerate(features)
    ])
    values = score(mixed).groupBy("_row", "_at").agg(F.avg("score").alias("_value"))
    names = F.array(*[F.lit(f) for f in features])
    part = F.posexplode("_parts").alias("_feature", "_part")
    return (
        values.join(F.broadcast(known.select("_at", "_parts")), "_at").select("_row", "_value", part)
        .groupBy("_row", "_feature").agg(F.sum(F.col("_value") * F.col("_part")).alias("value"))
        .select(F.col("_row").alias("row_id"), names[F.col("_feature")].alias("feature"), "value")
    )
