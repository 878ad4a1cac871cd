"""Global ranks, splits and folds without putting a whole stratum into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from acreage.constants import CV_FOLDS, SEED, TEST_SHARE
from acreage.operators.joins import lookup_join
from acreage.session import keep

# A range of distinct values that one task may sort, and the square roots of the range counts.
_RANGE_ROWS = 1_000_000
_GROUP_SIZES = (16, 64, 256)


def value_ranks(long: DataFrame, variable: str, value: str) -> DataFrame:
    """Rank of every distinct `(variable, value)`: columns n, first_rank, mean_rank, total.

    Equal values are counted on the map side, so a hot value is one row from then on. Quantile
    split points of the distinct values, fixed as literals before use, cut each variable into
    ranges, the more the larger it is; a running count inside a range plus the size of the ranges
    before it is the rank. No task sees more than one range. The number of variables must be small.
    """
    counts = keep(long.groupBy(variable, value).agg(F.count("*").alias("n")))
    sizes = counts.groupBy(variable).agg(F.count("*").alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    groups = next((g for g in _GROUP_SIZES if g * g * _RANGE_ROWS >= largest), _GROUP_SIZES[-1])
    ranges = groups * groups
    probes = [i / ranges for i in range(1, ranges)]
    splits = counts.groupBy(variable).agg(
        F.array_distinct(F.percentile_approx(value, probes, 4 * ranges)).alias("splits")
    ).collect()
    fixed = long.sparkSession.createDataFrame(
        [(row[0], row[1], row[1][groups - 1::groups]) for row in splits],
        f"{variable} string, _splits array<double>, _coarse array<double>",
    )

    def reached(points: Column) -> Column:
        return F.size(F.filter(points, lambda s: s <= F.col(value)))

    first = F.col("_group") * groups
    ranged = (
        counts.join(F.broadcast(fixed), variable)
        .withColumn("_group", reached(F.col("_coarse")))
        .withColumn("_range", first + reached(F.slice(F.col("_splits"), first + 1, F.lit(groups))))
        .select(variable, value, "n", "_range")
    )
    by_variable = Window.partitionBy(variable)
    before = (
        ranged.groupBy(variable, "_range").agg(F.sum("n").alias("_size"))
        .withColumn("total", F.sum("_size").over(by_variable))
        .withColumn("_before", F.sum("_size").over(by_variable.orderBy("_range")) - F.col("_size"))
        .drop("_size")
    )
    upto = F.sum("n").over(Window.partitionBy(variable, "_range").orderBy(value))
    # at most 65,536 ranges per variable
    return (
        ranged.join(F.broadcast(before), [variable, "_range"])
        .withColumn("first_rank", F.col("_before") + upto - F.col("n") + 1)
        .withColumn("mean_rank", F.col("first_rank") + (F.col("n") - 1) / 2)
        .select(variable, value, "n", "first_rank", "mean_rank", "total")
    )


def _with_hash(df: DataFrame, key: str, stratum: str | None, seed: int) -> DataFrame:
    """Shuffle order of the rows: the digest of seed and key, and its first four hex digits."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumns({
        "_stratum": F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit(""),
        "_digest": digest,
    }).withColumn("_slot", F.substring("_digest", 1, 4))


def _slot_sizes(hashed: DataFrame) -> DataFrame:
    """Rows per stratum and slot with the totals before them; at most 65,536 slots a stratum."""
    whole = Window.partitionBy("_stratum")
    return (
        hashed.groupBy("_stratum", "_slot").agg(F.count("*").alias("_size"))
        .withColumn("_upto", F.sum("_size").over(whole.orderBy("_slot")))
        .withColumn("_total", F.sum("_size").over(whole))
    )


def stratified_split(
    df: DataFrame, key: str, stratum: str | None, test_share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Add `split`: the first round(share * size) rows of each stratum in digest order are `test`.

    Only the slot that holds the cut is ranked row by row; the rest is decided by comparing with
    the digest at the cut, so the rows themselves are never shuffled. `key` must be unique.
    """
    hashed = _with_hash(df, key, stratum, seed)
    sizes = _slot_sizes(hashed).withColumn("_take", F.round(F.col("_total") * F.lit(test_share)))
    cut = sizes.filter(
        (F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_size") < F.col("_take"))
    ).select("_stratum", "_slot", (F.col("_take") - F.col("_upto") + F.col("_size")).alias("_need"))
    order = Window.partitionBy("_stratum").orderBy("_digest", key)
    last = (
        lookup_join(hashed.select("_stratum", "_slot", "_digest", key), cut, ["_stratum", "_slot"], "inner")
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == F.col("_need"))
        .select("_stratum", F.col("_digest").alias("_cut_digest"), F.col(key).alias("_cut_key"))
    )
    test = (F.col("_digest") < F.col("_cut_digest")) | (
        (F.col("_digest") == F.col("_cut_digest")) & (F.col(key) <= F.col("_cut_key"))
    )
    return (
        lookup_join(hashed, last, ["_stratum"])
        .withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train")))
        .drop("_stratum", "_slot", "_digest", "_cut_digest", "_cut_key")
    )


def digest_rank(df: DataFrame, key: str, stratum: str | None, seed: int = SEED, name: str = "rank") -> DataFrame:
    """Add the rank from 1 of every row in the digest order of its stratum; `key` must be unique.

    The rank inside a slot plus the rows of the slots before it gives the rank in the stratum, so
    a stratum is spread over its slots.
    """
    hashed = _with_hash(df, key, stratum, seed)
    before = _slot_sizes(hashed).select(
        "_stratum", "_slot", (F.col("_upto") - F.col("_size")).alias("_before")
    )
    order = Window.partitionBy("_stratum", "_slot").orderBy("_digest", key)
    return (
        hashed.join(before, ["_stratum", "_slot"])
        .withColumn(name, F.col("_before") + F.row_number().over(order))
        .drop("_stratum", "_slot", "_digest", "_before")
    )


def assign_folds(
    df: DataFrame, key: str, stratum: str | None, folds: int = CV_FOLDS, seed: int = SEED
) -> DataFrame:
    """Add `fold`, dealing the rows of each stratum in digest order."""
    ranked = digest_rank(df, key, stratum, seed, "_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")


def sample_rows(df: DataFrame, key: str, rows: int, seed: int = SEED) -> DataFrame:
    """At most `rows` rows, the first in digest order; each task keeps only that many."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(digest, key).limit(rows)
