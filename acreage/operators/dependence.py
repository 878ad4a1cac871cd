"""How strongly each numeric feature depends on the target."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from acreage.operators.guards import LeakageError
from acreage.operators.joins import lookup_join
from acreage.operators.ranking import value_ranks
from acreage.session import keep, stage


def pearson(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """`(feature, pearson)` from one pass without a shuffle of rows."""
    y = F.col(target).cast("double")

    def strength(feature: str):
        x = F.when(y.isNotNull(), F.col(feature).cast("double"))
        y_here = F.when(x.isNotNull(), y)
        return F.try_divide(F.covar_pop(x, y_here), F.stddev_pop(x) * F.stddev_pop(y_here))

    row = df.agg(*[strength(f).alias(f"r{i}") for i, f in enumerate(features)])
    scores = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"r{i}").alias("pearson")) for i, f in enumerate(features)
    ]))
    return row.select(scores.alias("_s")).select("_s.*")


def _ranked_pairs(df: DataFrame, features: list[str], target: str, bins: int) -> DataFrame:
    """`(feature, n, rank and bin of both sides)` per distinct pair of values."""
    long = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x"),
                     F.col(target).cast("double").alias("y")) for f in features
        ])).alias("_p")).select("_p.*").filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    )
    # features go by their number, so that names of any length and form do
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")).cast("string")
    pairs = long.groupBy("feature", "x", "y").agg(F.count("*").alias("weight"))
    sides = F.explode(F.array(*[
        F.struct(F.concat(F.lit(f"{side}:"), place).alias("variable"), F.col(side).alias("value"))
        for side in ("x", "y")
    ]))
    ranks = keep(value_ranks(long.select(sides.alias("_s")).select("_s.*"), "variable", "value"))

    for side in ("x", "y"):
        table = ranks.filter(F.col("variable").startswith(f"{side}:")).select(
            F.element_at(F.array(*[F.lit(f) for f in features]), F.split("variable", ":")[1].cast("int")).alias("feature"),
            F.col("value").alias(side),
            (F.col("mean_rank") - (F.col("total") + 1) / 2).alias(f"{side}_rank"),
            F.floor(bins * (F.col("first_rank") - 1) / F.col("total")).alias(f"{side}_bin"),
        )
        pairs = lookup_join(pairs, table, ["feature", side], "inner")
    return pairs


def _spearman(pairs: DataFrame) -> DataFrame:
    w, x, y = F.col("weight"), F.col("x_rank"), F.col("y_rank")
    return pairs.groupBy("feature").agg(
        F.sum("weight").alias("n"),
        F.try_divide(F.sum(w * x * y), F.sqrt(F.sum(w * x * x) * F.sum(w * y * y))).alias("spearman"),
    )


def _normalised_information(pairs: DataFrame) -> DataFrame:
    """At most bins * bins cells per feature reach the windows."""
    cells = pairs.groupBy("feature", "x_bin", "y_bin").agg(F.sum("weight").alias("n"))
    whole = Window.partitionBy("feature")
    n, total = F.col("n"), F.sum("n").over(whole)
    cells = cells.select(
        "feature", n, total.alias("total"),
        F.size(F.collect_set("x_bin").over(whole)).alias("kx"), F.size(F.collect_set("y_bin").over(whole)).alias("ky"),
        F.sum("n").over(Window.partitionBy("feature", "x_bin")).alias("nx"),
        F.sum("n").over(Window.partitionBy("feature", "y_bin")).alias("ny"),
    )
    share = F.col("n") / F.col("total")
    hx = -F.sum(share * F.ln(F.col("nx") / F.col("total")))
    hy = -F.sum(share * F.ln(F.col("ny") / F.col("total")))
    gain = F.sum(share * F.ln(share / (F.col("nx") / F.col("total")) / (F.col("ny") / F.col("total"))))
    # what independent sides would share on average, which few rows in many bins make large
    free = (F.first("kx") - 1) * (F.first("ky") - 1)
    chance = free / (2 * F.first("total"))
    return cells.groupBy("feature").agg(
        F.when((hx <= 0) | (hy <= 0), F.lit(0.0)).otherwise(F.try_divide(gain, F.sqrt(hx * hy))).alias("nmi"),
        F.when((hx > 0) & (hy > 0), F.try_divide(gain - chance, F.sqrt(hx * hy))).alias("beyond_chance"),
    )


def dependence_scores(
    df: DataFrame, features: list[str], target: str, max_abs_corr: float = 0.95, nmi_threshold: float = 0.8,
    bins: int = 10,
) -> DataFrame:
    """Per feature: n, pearson, spearman, nmi over `bins` equal-frequency bins, and the verdict `flagged`.

    Information counts for the verdict as far as it exceeds chance. Ranks use the rows where both sides are present. Rows are counted per distinct pair and ranks
    per distinct value, so a hot value is a single row when the two are joined.
    """
    df = stage(df.select(*features, target), "dependence")
    pairs = keep(_ranked_pairs(df, features, target, bins))
    scores = (
        _spearman(pairs).join(_normalised_information(pairs), "feature")
        .join(pearson(df, features, target), "feature")
    )
    flagged = (
        (F.abs("pearson") > max_abs_corr) | (F.abs("spearman") > max_abs_corr) | (F.col("beyond_chance") > nmi_threshold)
    )
    return scores.select(
        "feature", "n", "pearson", "spearman", "nmi", F.coalesce(flagged, F.lit(False)).alias("flagged")
    )


def check_target_independence(
    df: DataFrame, features: list[str], target: str, max_abs_corr: float = 0.95, nmi_threshold: float = 0.8
) -> None:
    """Refuse features that nearly determine the target; an empty table passes."""
    scores = dependence_scores(df, features, target, max_abs_corr, nmi_threshold)
    bad = [row["feature"] for row in scores.filter("flagged").orderBy("feature").collect()]
    if bad:
        raise LeakageError(f"features correlated with the target: {bad}")
