"""Exact nearest neighbours by pivot cells and the triangle inequality.

Equal vectors count as one point with the smallest of their keys, so copies cost nothing. Every point belongs to the cell of
its nearest pivot. A point finds neighbours in its own cell, which bounds how far they can lie; then it visits only
the other cells whose ring about the pivot, or box, comes within that bound. A crowd of visitors is dealt
over several copies of a cell. The result is the same for any number of partitions, cells and pivots.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from acreage.constants import SEED
from acreage.operators.joins import lookup_join
from acreage.session import stage

#: Bytes of distances held at once, and most visitors of one copy of a cell.
HELD, VISITORS = 32 << 20, 20_000
_FOUND = "array<struct<distance: double, key: long>>"
_KEYS = pa.list_(pa.struct([("distance", pa.float64()), ("key", pa.int64())]))


def matrix(column, dimensions: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, added up in the order of the dimensions, so that they are the same wherever they are found."""
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        total += (a[:, d][:, None] - b[:, d][None]) ** 2
    return np.sqrt(total)


def nearest_keys(points: np.ndarray, members: np.ndarray, keys: list[np.ndarray], most: int, bound: np.ndarray):
    """(point number, distance, key) of the `most` nearest keys of the members for each point, none beyond its bound.

    Of equal distances smaller keys come first; a member's keys are its smallest ones, at most `most`, in order."""
    sizes = np.array([len(k) for k in keys])
    starts, flat = np.cumsum(sizes) - sizes, np.concatenate(keys)
    first = flat[starts]
    out = []
    for a in range(0, len(points), max(1, HELD // (8 * len(members)))):
        part = points[a:a + max(1, HELD // (8 * len(members)))]
        apart = distances(part, members)
        near = apart <= bound[a:a + len(part), None]
        if most < len(members):
            near &= apart <= np.partition(apart, most - 1, axis=1)[:, most - 1:most]
        i, j = np.nonzero(near)
        d = apart[i, j]
        order = np.lexsort((first[j], d, i))
        i, j, d = i[order], j[order], d[order]
        # beyond `most` members nothing can be among the nearest keys, since each holds one at least
        few = np.arange(len(i)) - np.searchsorted(i, i) < most
        i, j, d = i[few], j[few], d[few]
        n = sizes[j]
        key = flat[np.arange(int(n.sum())) + np.repeat(starts[j] - (np.cumsum(n) - n), n)]
        i, d = np.repeat(i, n), np.repeat(d, n)
        order = np.lexsort((key, d, i))
        i, d, key = i[order], d[order], key[order]
        few = np.arange(len(i)) - np.searchsorted(i, i) < most
        out.append((i[few] + a, d[few], key[few]))
    return tuple(np.concatenate(x) for x in zip(*out))


def lists_of(n: int, found) -> pa.Array:
    i, d, key = found
    ends = pa.array(np.searchsorted(i, np.arange(n + 1)), pa.int32())
    values = pa.StructArray.from_arrays([pa.array(d), pa.array(key)], ["distance", "key"])
    return pa.ListArray.from_arrays(ends, values).cast(_KEYS)


class Cells:
    """Pivots of all groups and what is known of their cells: counts, rings and boxes."""

    def __init__(self, groups: list[str], pivots: np.ndarray):
        order = np.lexsort((*pivots.T[::-1], groups))
        self.groups, self.pivots = np.array(groups, dtype=object)[order], pivots[order]
        self.of = {g: np.flatnonzero(self.groups == g) for g in set(groups)}

    def home(self, group: str, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each point and how far its pivot is."""
        cells = self.of[group]
        where, far = [], []
        step = max(1, HELD // (8 * len(cells)))
        for a in range(0, len(points), step):
            apart = distances(points[a:a + step], self.pivots[cells])
            at = apart.argmin(axis=1)
            where.append(cells[at])
            far.append(apart[np.arange(len(at)), at])
        return np.concatenate(where), np.concatenate(far)

    def measure(self, rows: list) -> Cells:
        n, d = len(self.pivots), self.pivots.shape[1]
        self.n, self.inner, self.outer = np.zeros(n), np.full(n, np.inf), np.zeros(n)
        self.low, self.high = np.full((n, d), np.inf), np.full((n, d), -np.inf)
        for r in rows:
            c = r["cell"]
            self.n[c], self.inner[c], self.outer[c] = r["n"], r["inner"], r["outer"]
            self.low[c], self.high[c] = r["low"], r["high"]
        return self

    def visits(self, group: str, points: np.ndarray, home: np.ndarray, bound: np.ndarray, most: int):
        """(point number, cell) of all other cells that may hold one of the `most` nearest, and the bounds this took."""
        cells = self.of[group]
        cells = cells[self.n[cells] > 0]
        out, bounds = [], []
        step = max(1, HELD // (8 * len(cells)))
        for a in range(0, len(points), step):
            part = points[a:a + step]
            apart = distances(part, self.pivots[cells])
            # members of a cell lie within its ring, so some cells' worth of them lie within this
            reach = apart + self.outer[cells]
            order = np.argsort(reach, axis=1)
            enough = (np.cumsum(self.n[cells][order], axis=1) >= most)
            at = enough.argmax(axis=1)
            safe = np.where(enough.any(axis=1), reach[np.arange(len(part)), order[np.arange(len(part)), at]], np.inf)
            limit = np.minimum(bound[a:a + step], safe * (1 + 1e-12))
            least = np.maximum(apart - self.outer[cells], self.inner[cells] - apart)
            gap = np.zeros_like(apart)
            for d in range(part.shape[1]):
                x = part[:, d][:, None]
                gap += np.maximum(0, np.maximum(self.low[cells, d] - x, x - self.high[cells, d])) ** 2
            least = np.maximum(least, np.sqrt(gap)) * (1 - 1e-12) - 1e-300
            i, j = np.nonzero((least <= limit[:, None]) & (cells[None, :] != home[a:a + step, None]))
            out.append((i + a, cells[j]))
            bounds.append(limit)
        return *(np.concatenate(x) for x in zip(*out)), np.concatenate(bounds)


def in_cells(members: DataFrame, most: int, dimensions: int) -> DataFrame:
    """(point, found, bound) of every member: the nearest keys of its own cell, and how far the last of enough lies."""
    def search(table: pa.Table) -> pa.Table:
        x = matrix(table.column("vector"), dimensions)
        keys = [np.array(k) for k in table.column("keys").to_pylist()]
        i, d, key = nearest_keys(x, x, keys, most, np.full(len(x), np.inf))
        n = np.bincount(i, minlength=len(x))
        last = np.cumsum(n) - 1
        bound = np.where(n >= most, d[last], np.inf)
        return pa.table([table.column("point"), lists_of(len(x), (i, d, key)), pa.array(bound)], ["point", "found", "bound"])

    return members.groupBy("cell").applyInArrow(search, f"point long, found {_FOUND}, bound double")


def visited(visitors: DataFrame, members: DataFrame, most: int, dimensions: int) -> DataFrame:
    """(point, found): the nearest keys each visitor finds in a cell it visits, within its bound."""
    def search(some: pa.Table, own: pa.Table) -> pa.Table:
        if not some.num_rows or not own.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], _KEYS)], ["point", "found"])
        keys = [np.array(k) for k in own.column("keys").to_pylist()]
        bound = some.column("bound").to_numpy()
        found = nearest_keys(matrix(some.column("vector"), dimensions), matrix(own.column("vector"), dimensions), keys, most, bound)
        return pa.table([some.column("point"), lists_of(len(bound), found)], ["point", "found"])

    # one row per cell
    crowds = visitors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(VISITORS)).cast("int").alias("copies"))
    dealt = visitors.join(F.broadcast(crowds), "cell").withColumn("copy", F.pmod(F.xxhash64("point"), F.col("copies")).cast("int"))
    copied = members.join(F.broadcast(crowds), "cell").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return dealt.drop("copies").groupBy("cell", "copy").cogroup(copied.drop("copies").groupBy("cell", "copy")).applyInArrow(
        search, f"point long, found {_FOUND}")


def nearest_rows(
    df: DataFrame, key: str, vector: str, k: int, dimensions: int, group: str | None = None, cell: int = 2000,
    most_cells: int = 20_000, seed: int = SEED,
) -> DataFrame:
    """`(key, other, distance)`: the k nearest other rows of each row within its group, ties to the smaller key.

    `key` is a unique whole number. Rows whose vector is null, or holds a null or NaN, have no neighbours and are none; a null
    group is a group of its own. A group of n rows yields at most n - 1 neighbours a row. There is about one pivot per
    `cell` different vectors, drawn by hash, and at most about `most_cells` plus one per group; they and the measures of
    their cells are all that the driver and every task hold.
    """
    # a null group has a name of its own, so that joins find it
    name = F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit("")) if group else F.lit("")
    rows = df.select(F.col(key).cast("long").alias("key"), name.alias("_group"), F.col(vector).cast("array<double>").alias("vector"))
    whole = F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x))
    rows = rows.where(whole).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # -0 becomes 0
    rows = stage(rows, "vectors")
    first = Window.partitionBy("_group", "vector").orderBy("key")
    # at most k + 1 keys of a vector are collected
    points = stage(
        rows.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") <= k + 1)
        .groupBy("_group", "vector").agg(F.array_sort(F.collect_list("key")).alias("keys"))
        .withColumn("point", F.monotonically_increasing_id()), "points")
    schema = "key long, other long, distance double"
    sizes = {r["_group"]: r["n"] for r in points.groupBy("_group").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return df.sparkSession.createDataFrame([], schema)
    room = max(cell, sum(sizes.values()) // most_cells)
    luck = F.pmod(F.xxhash64("vector", F.lit(seed)), F.lit(1 << 30))
    least = points.groupBy("_group").agg(F.min_by("vector", F.struct(luck, "vector")).alias("vector"))
    drawn = points.where(luck < F.lit(float(1 << 30) / room)).select("_group", "vector")
    pivots = least.unionByName(drawn).distinct().collect()
    cells = Cells([r["_group"] for r in pivots], np.array([r["vector"] for r in pivots], float).reshape(-1, dimensions))

    def assign(batches):
        for batch in batches:
            names = np.array(batch.column("_group").to_pylist(), dtype=object)
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            home, far = np.zeros(len(x), np.int64), np.zeros(len(x))
            for g in set(names.tolist()):
                at = np.flatnonzero(names == g)
                home[at], far[at] = cells.home(g, x[at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home), pa.array(far)], [*batch.schema.names, "cell", "far"])

    members = stage(points.mapInArrow(assign, "_group string, vector array<double>, keys array<long>, point long, cell long, far double"), "members")
    sides = [F.array(*[f(F.get("vector", F.lit(d))) for d in range(dimensions)]).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
    held = cells.measure(members.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("far").alias("inner"), F.max("far").alias("outer"), *sides).collect())
    own = stage(in_cells(members, k + 1, dimensions), "own")

    def leave(batches):
        for batch in batches:
            names = np.array(batch.column("_group").to_pylist(), dtype=object)
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            home, bound = (batch.column(c).to_numpy() for c in ("cell", "bound"))
            for g in set(names.tolist()):
                at = np.flatnonzero(names == g)
                i, where, limit = held.visits(g, x[at], home[at], bound[at], k + 1)
                for a in range(0, len(i), 10_000):
                    who = at[i[a:a + 10_000]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(where[a:a + 10_000]), batch.column("point").take(pa.array(who)), batch.column("vector").take(pa.array(who)),
                        pa.array(limit[i[a:a + 10_000]])], ["cell", "point", "vector", "bound"])

    bounded = members.select("_group", "vector", "point", "cell").join(own.select("point", "bound"), "point")
    visitors = stage(bounded.mapInArrow(leave, "cell long, point long, vector array<double>, bound double"), "visitors")
    more = visited(visitors, members.select("cell", "vector", "keys"), k + 1, dimensions)
    # a point has one list of k + 1 per cell it visits
    best = own.select("point", "found").unionByName(more).groupBy("point").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found"))
    answers = stage(members.select("point", "_group", "vector").join(best, "point").select("_group", "vector", "found"), "answers")
    others = F.slice(F.filter("found", lambda f: f["key"] != F.col("key")), 1, k)
    return lookup_join(rows, answers, ["_group", "vector"], "inner").select("key", F.explode(others).alias("f")).select(
        "key", F.col("f.key").alias("other"), F.col("f.distance").alias("distance"))
