"""Class balancing: synthetic rows between neighbours, then removal of rows their neighbours deny."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from acreage.constants import SEED
from acreage.functions.scalar import literal_map
from acreage.ml.neighbours import nearest_rows
from acreage.operators.ranking import digest_rank
from acreage.session import stage

_PAIR = "key long, other long"
#: Copies of one row that one task makes.
_COPIES = 10_000


def _adjacent(reach: int):
    """Pairs of rows whose ranks are at most `reach` apart, within one projection and group.

    Rows come sorted by block and rank; a block also holds the rows that follow it within reach, and a
    pair belongs to the block of its earlier row."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = pd.DataFrame({"block": [], "part": [], "rank": [], "key": [], "own": []})
        for batch in batches:
            rows = pd.concat([tail, batch[list(tail.columns)]], ignore_index=True)
            block, part, own = rows["block"].to_numpy(), rows["part"].to_numpy(), rows["own"].to_numpy(dtype=bool)
            key, old = rows["key"].to_numpy(dtype="int64"), len(tail)
            for offset in range(1, min(reach, len(rows) - 1) + 1):
                # the later row of each pair is new, so that no pair comes twice
                later = np.arange(max(offset, old), len(rows))
                later = later[(part[later] == part[later - offset]) & (block[later] == block[later - offset]) & own[later - offset]]
                a, b = key[later], key[later - offset]
                yield pd.DataFrame({"key": np.concatenate([a, b]), "other": np.concatenate([b, a])})
            tail = rows.tail(reach)

    return pairs


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with their place in `order`, which must be total; no task sees more than its share."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(sorted_.withColumn("_id", F.monotonically_increasing_id()), "sorted")
    task = F.shiftright("_id", 33)
    counts = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("n")).orderBy("_task").collect()
    starts, seen = [], 0
    for r in counts:  # one row per task
        starts.append((r["_task"], seen))
        seen += r["n"]
    table = F.broadcast(rows.sparkSession.createDataFrame(starts, "_task long, _start long"))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_task", task).join(table, "_task").withColumn("rank", F.col("_start") + within).drop("_id", "_task", "_start")


def _squared_distance(a: str, b: str) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)


def neighbours(
    df: DataFrame, key: str, vector: str, k: int, dimensions: int, group: str | None = None,
    projections: int = 8, reach: int | None = None, seed: int = SEED, block: int = 10_000,
) -> DataFrame:
    """`(key, other, distance)`: the k nearest of the rows found near each row, within its group.

    Rows are ranked along seeded random directions, ties by a hash of the key, and compared with the
    `reach` rows on either side. Ranks are cut into blocks that overlap by `reach`, so the answer is the same
    for any number of partitions. It is exact once `reach` covers a group and approximate below; the
    pairs stay linear in the rows either way.
    """
    reach = reach or 8 * k
    rng = random.Random(seed)
    directions = [[rng.gauss(0, 1) for _ in range(dimensions)] for _ in range(projections)]
    along = F.array(*[
        F.aggregate(F.zip_with(vector, F.array(*[F.lit(x) for x in d]), lambda a, b: a * b),
                    F.lit(0.0), lambda total, x: total + x) for d in directions
    ])
    name = F.col(group).cast("string") if group else F.lit("")
    placed = df.select(F.col(key).alias("key"), name.alias("_group"), F.posexplode(along).alias("_line", "_at")).select(
        F.concat_ws(":", "_line", "_group").alias("part"), "_at", F.xxhash64("key").alias("_spread"), "key")
    ranked = _ranked(placed, ["part", "_at", "_spread", "key"]).select("part", "rank", "key")
    home = F.floor(F.col("rank") / block)
    # rows within reach of a block's end are also shown to the blocks before
    blocks = F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("rank") - reach) / block)), home))
    shown = ranked.withColumn("block", blocks).withColumn("own", F.col("block") == home)
    found = (
        shown.repartition("block").sortWithinPartitions("block", "rank")
        .mapInPandas(_adjacent(reach), _PAIR).distinct()
    )
    here = df.select(F.col(key).alias("key"), F.col(vector).alias("_a"))
    there = df.select(F.col(key).alias("other"), F.col(vector).alias("_b"))
    nearest = Window.partitionBy("key").orderBy("distance", "other")
    return (
        found.join(here, "key").join(there, "other")
        .select("key", "other", F.sqrt(_squared_distance("_a", "_b")).alias("distance"))
        .withColumn("_nth", F.row_number().over(nearest)).filter(F.col("_nth") <= k).drop("_nth")
    )


def _uniform(*parts) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def oversample(
    df: DataFrame, key: str, features: list[str], label: str, k: int = 5, seed: int = SEED, **search
) -> DataFrame:
    """Bring every class to the size of the largest with rows between a row and a near one.

    Columns: key, features, label, `synthetic`. Keys of new rows are negative.
    """
    rows = df.select(key, label, *features).withColumn("_x", F.array(*[F.col(f).cast("double") for f in features]))
    sizes = {r[0]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    largest = max(sizes.values())
    minority = [c for c, n in sizes.items() if n < largest]
    kept = df.select(key, *features, label).withColumn("synthetic", F.lit(False))
    if not minority:
        return kept
    small = stage(rows.filter(F.col(label).isin(minority)), "minority")
    whole = literal_map({c: (largest - n) // n for c, n in sizes.items()})
    rest = literal_map({c: (largest - n) % n for c, n in sizes.items()})
    near = nearest_rows(small, key, "_x", k, len(features), label, seed=seed, **search).groupBy(
        F.col("key").alias(key)).agg(F.collect_list("other").alias("_others"))
    # a row lists at most k others
    many = whole[F.col(label)] + F.when(F.col("_rank") <= rest[F.col(label)], 1).otherwise(0)
    copies = (
        digest_rank(small, key, label, seed, "_rank").join(near, key, "left")
        .withColumn("_copies", many).filter(F.col("_copies") > 0)
        .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"), F.lit(_COPIES).cast("long"))))
        .repartition(F.xxhash64(key, "_from"))  # a rare row's many copies are made by many tasks
        .withColumn("_copy", F.explode(F.sequence("_from", F.least("_copies", F.col("_from") + _COPIES - 1))))
        .withColumn("_pick", F.get(
            F.array_sort("_others"),
            F.floor(_uniform(key, "_copy", F.lit(seed)) * F.size("_others")).cast("int")))
        .withColumn("_part", _uniform(key, "_copy", F.lit(seed + 1)))
    )
    other = small.select(F.col(key).alias("_pick"), F.col("_x").alias("_y"))
    mixed = F.when(F.col("_y").isNull(), F.col("_x")).otherwise(
        F.zip_with("_x", "_y", lambda a, b: a + (b - a) * F.col("_part")))
    made = copies.join(other, "_pick", "left").withColumn("_new", mixed).select(
        (-F.pmod(F.xxhash64(key, "_copy"), F.lit((1 << 62) - 1)) - 1).alias(key),
        *[F.get("_new", F.lit(i)).cast(df.schema[f].dataType).alias(f) for i, f in enumerate(features)],
        label, F.lit(True).alias("synthetic"),
    )
    return kept.unionByName(made)


def edit(df: DataFrame, key: str, features: list[str], label: str, k: int = 3, seed: int = SEED, **search) -> DataFrame:
    """Drop rows with a neighbour of another class among their k nearest."""
    rows = stage(df.withColumn("_x", F.array(*[F.col(f).cast("double") for f in features])), "edited")
    near = nearest_rows(rows, key, "_x", k, len(features), seed=seed, **search)
    other = rows.select(F.col(key).alias("other"), F.col(label).alias("_theirs"))
    denied = (
        near.withColumnRenamed("key", key).join(rows.select(key, label), key).join(other, "other")
        .filter(F.col(label) != F.col("_theirs")).select(key).distinct()
    )
    return rows.join(denied, key, "left_anti").select(*df.columns)


def oversample_and_edit(
    df: DataFrame, key: str, features: list[str], label: str, k: int = 5, edit_k: int = 3, seed: int = SEED, **search
) -> DataFrame:
    return edit(oversample(df, key, features, label, k, seed, **search), key, features, label, edit_k, seed, **search)
