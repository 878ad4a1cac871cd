"""Gradient boosting on histograms, all classes of a round together.

Features are cut into bins once. Every row is kept in a block of codes, labels and margins, many blocks to a task. A round
derives gradients and curvatures of all rows once and keeps them; each of its jobs routes the rows down the unfinished
trees, adds them up per node, feature and bin, and Spark sums these
histograms and picks each node's best split, so that only splits come to the driver. Where the rows are few enough for
one task, a round is one job instead, in which each task grows the whole tree of one output by the same sums. The sums are
of integers, hence the model is the same for any number of partitions. Margins are written every few rounds, and
a job adds the trees grown since, so a lost executor costs one re-read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
    MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.constants import SEED
from acreage.functions.scalar import argmax
from acreage.ml.trees import Tree, score
from acreage.session import discard, last_staged, stage

#: Rounds after which margins are written, rows of a block, rows from which bins are cut, and tasks summed at once.
ROUNDS_HELD, BLOCK_ROWS, SAMPLE, FAN = 8, 4096, 100_000, 64
#: Rows of a task, whose histograms are as large as if it held one block; blocks whose sums of whole numbers stay exact together.
TASK_ROWS, MERGED = 1 << 20, 8
#: Nodes whose histograms one task adds up, and blocks up to which one task grows a whole tree.
SLOTS_A_TASK, WHOLE_BLOCKS = 32, 32
#: Rows of an Arrow batch over blocks and histograms, whose rows are up to some megabytes; Spark's own number would put all of a task into one.
BATCH_ROWS, BATCH_CONF = 8, "spark.sql.execution.arrow.maxRecordsPerBatch"
READ_CONF = "spark.sql.parquet.columnarReaderBatchSize"
#: Whether a union of tables of one partition is one task, which would grow all trees one after another.
UNION_CONF = "spark.sql.unionOutputPartitioning"
#: Diagonal bound of the softmax curvature, as the published boosters take it (a fixed value).
CURVATURE = 2.0
SOFTMAX, SQUARED = "softmax", "squared"
_BLOCK = "codes binary, target binary, weight binary, draw binary, margin binary"
HISTOGRAM = "slot int, g binary, h binary"
_DERIVED = "codes binary, g binary, h binary"
_SPLIT = "slot int, feature int, bin int, gain double, g double, h double, left_g double, left_h double"


@dataclass(frozen=True)
class Settings:
    """What a fit is told; `leaves` of 0 grows by level to `depth`, else the best leaf first up to that many."""

    objective: str = SOFTMAX
    classes: int = 4
    rounds: int = 500
    depth: int = 6
    leaves: int = 0
    rate: float = 0.1
    l1: float = 0.0
    l2: float = 1.0
    least_gain: float = 0.0
    least_weight: float = 1.0
    subsample: float = 1.0
    column_share: float = 1.0
    top_share: float = 1.0
    other_share: float = 0.0
    bins: int = 256
    seed: int = SEED

    @property
    def outputs(self) -> int:
        return self.classes if self.objective == SOFTMAX else 1


@dataclass
class Node:
    """A node of a tree that grows; `split` is (feature, bin, gain) once it is known, None if there is none."""

    g: float
    h: float
    depth: int
    known: bool = False
    split: tuple[int, int, float] | None = None
    sides: tuple[float, float] = (0.0, 0.0)
    children: tuple[int, int] | None = None

    def know(self, feature: int, cut: int, gain: float, g: float, h: float, left_g: float, left_h: float) -> None:
        self.known, self.g, self.h, self.sides = True, float(g), float(h), (left_g, left_h)
        self.split = (feature, cut, gain) if feature >= 0 else None


@dataclass
class Growing:
    """A tree that grows. All known splits route rows; which of them stay is decided by `kept`."""

    nodes: list[Node] = field(default_factory=lambda: [Node(0.0, 0.0, 0)])

    def divide(self, at: int) -> None:
        node = self.nodes[at]
        if node.children is None and node.split:
            left = Node(*node.sides, node.depth + 1)
            right = Node(node.g - left.g, node.h - left.h, node.depth + 1)
            node.children = (len(self.nodes), len(self.nodes) + 1)
            self.nodes += [left, right]

    def kept(self, limit: int) -> tuple[list[int], list[int], bool]:
        """Splits taken best first up to `limit` leaves, the open ones, and whether an unknown node stands in the way."""
        taken, heap = [], []

        def offer(at: int) -> bool:
            node = self.nodes[at]
            if node.known and node.split:
                heapq.heappush(heap, (-node.split[2], at))
            return node.known

        if not offer(0):
            return taken, [], True
        while heap and len(taken) + 1 < limit:
            at = heapq.heappop(heap)[1]
            taken.append(at)
            self.divide(at)
            if len(taken) + 1 < limit and not all([offer(c) for c in self.nodes[at].children]):
                return taken, [a for _, a in heap], True
        return taken, [a for _, a in heap], False

    def wanted(self, settings: Settings) -> list[int]:
        """Nodes whose splits the next job is to find; none when the tree is done."""
        if settings.leaves:
            taken, open_, waiting = self.kept(settings.leaves)
            if not waiting:
                return []
            for at in open_:  # their children may be next, so they are asked for ahead
                self.divide(at)
            near = [0, *[c for at in [*taken, *open_] for c in self.nodes[at].children]]
            return [a for a in near if not self.nodes[a].known]
        for at in range(len(self.nodes)):
            self.divide(at)
        return [a for a, n in enumerate(self.nodes) if not n.known and n.depth < settings.depth]

    def routes(self) -> tuple[np.ndarray, ...]:
        rows = [(n.split[0], n.split[1], *n.children) if n.children else (-1, 0, 0, 0) for n in self.nodes]
        return tuple(np.array(x, np.int64) for x in zip(*rows))

    def finished(self, settings: Settings, value) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
        """Routes, leaf values and covers of the splits that stay, numbered anew."""
        stay = set(self.kept(settings.leaves)[0]) if settings.leaves else {a for a, n in enumerate(self.nodes) if n.children}
        order, rows, at = [0], [], 0
        while at < len(order):
            node = self.nodes[order[at]]
            if order[at] in stay:
                rows.append((node.split[0], node.split[1], len(order), len(order) + 1))
                order += node.children
            else:
                rows.append((-1, 0, 0, 0))
            at += 1
        values = np.array([value(self.nodes[a].g, self.nodes[a].h) for a in order])
        return (tuple(np.array(x, np.int64) for x in zip(*rows)), values, np.array([self.nodes[a].h for a in order]))


def routed(codes: np.ndarray, routes: tuple[np.ndarray, ...]) -> np.ndarray:
    """The last node each row reaches; `codes` has a row per feature."""
    feature, cut, left, right = routes
    end, n = feature < 0, codes.shape[1]
    own = np.arange(len(feature))
    start, cut = np.where(end, 0, feature) * n, np.where(end, 255, cut)
    children = np.column_stack([np.where(end, own, left), np.where(end, own, right)]).ravel()
    deep = np.zeros(len(feature), int)
    for node in np.flatnonzero(~end):  # children come after their parent
        deep[[left[node], right[node]]] = deep[node] + 1
    flat, rows, node = codes.ravel(), np.arange(n), np.zeros(n, np.int64)
    for _ in range(deep.max()):
        node = children[2 * node + (flat[start[node] + rows] > cut[node])]
    return node


def node_sums(codes: np.ndarray, slot: np.ndarray, values: tuple[np.ndarray, ...], nodes: int, starts: np.ndarray) -> list[np.ndarray]:
    """Sums of each of the whole-number `values` per node (`slot` of a row), feature and bin, a row per node."""
    sums = [np.zeros((nodes, int(starts[-1])), np.int64) for _ in values]
    whole = [np.bincount(slot, v, nodes) for v in values]
    for own, first, width in zip(codes, starts, np.diff(starts)):
        if width == 1:
            for total, all_ in zip(sums, whole):
                total[:, first] = all_
        elif width == 2:  # one side is the rest
            rows = np.flatnonzero(own)
            at = slot[rows]
            for total, v, all_ in zip(sums, values, whole):
                over = np.bincount(at, v[rows], nodes)
                total[:, first], total[:, first + 1] = all_ - over, over
        else:
            at = slot * width + own
            for total, v in zip(sums, values):
                total[:, first:first + width] = np.bincount(at, v, nodes * width).reshape(nodes, width)
    return sums


def soft(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def gradients(settings: Settings, target: np.ndarray, weight: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss, a row per output."""
    if settings.objective == SQUARED:
        return (margin - target) * weight, np.broadcast_to(weight, margin.shape)
    p = np.exp(margin - margin.max(axis=0))
    p /= p.sum(axis=0)
    truth = target[None, :] == np.arange(settings.classes)[:, None]
    return (p - truth) * weight, np.maximum(CURVATURE * p * (1 - p), 1e-16) * weight


def drawn(draw: np.ndarray, seed: int, round_: int) -> np.ndarray:
    """A number in [0, 1) per row and round, from the row's own hash."""
    x = draw + np.uint64((seed * 0x9E3779B97F4A7C15 + round_ * 0xBF58476D1CE4E5B9) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53


@dataclass
class Bins:
    """Cut values per feature; a code is how many cuts are below a value, so code <= b means value <= cuts[b]."""

    cuts: list[np.ndarray]

    @staticmethod
    def fit(x: np.ndarray, bins: int) -> Bins:
        cuts = []
        for column in x.T:
            values = np.sort(column[~np.isnan(column)])
            distinct = np.unique(values)
            if len(distinct) > bins:
                chosen = np.unique(values[np.arange(1, bins) * len(values) // bins])
                at = np.searchsorted(distinct, chosen)
                at = at[at < len(distinct) - 1]
            else:
                at = np.arange(max(0, len(distinct) - 1))
            middle = distinct[at] + (distinct[at + 1] - distinct[at]) / 2
            cuts.append(np.where(middle < distinct[at + 1], middle, distinct[at]))
        return Bins(cuts)

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.array([np.searchsorted(c, column, side="left") for c, column in zip(self.cuts, x.T)], np.uint8).reshape(len(self.cuts), len(x))

    @property
    def starts(self) -> np.ndarray:
        """Where the bins of each feature begin in a histogram, and their number at the end."""
        return np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])]).astype(np.int64)


def blocks_of(batch: pa.RecordBatch, outputs: int) -> Iterator[tuple[np.ndarray, ...]]:
    for row in zip(*[batch.column(c) for c in ("codes", "target", "weight", "draw", "margin")]):
        codes, target, weight, draw, margin = (np.frombuffer(v.as_buffer(), t) for v, t in zip(row, ("u1", "f8", "f8", "u8", "f8")))
        yield codes.reshape(-1, len(target)), target, weight, draw, margin.reshape(outputs, -1)


def merged(blocks: Iterator[tuple[np.ndarray, ...]], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of up to `most` blocks in a row, put together along the rows."""
    held = []
    for block in blocks:
        held.append(block)
        if len(held) == most:
            yield tuple(np.concatenate(parts, axis=-1) for parts in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(parts, axis=-1) for parts in zip(*held))


def packed(codes, target, weight, draw, margin) -> pa.RecordBatch:
    values = [[np.ascontiguousarray(x).tobytes()] for x in (codes, target, weight, draw, margin)]
    return pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) for v in values], ["codes", "target", "weight", "draw", "margin"])


def histogram_rows(slots, sums) -> pa.RecordBatch:
    """Rows (slot, g, h) of whole-number histograms."""
    return pa.RecordBatch.from_arrays([
        pa.array(slots, pa.int32()), *[pa.array([x[k].tobytes() for x in sums], pa.binary()) for k in range(2)]], ["slot", "g", "h"])


def sums_by_slot(batches) -> dict[int, list[np.ndarray]]:
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for slot, *parts in zip(batch.column("slot").to_pylist(), batch.column("g"), batch.column("h")):
            arrays = [np.frombuffer(p.as_buffer(), np.int64) for p in parts]
            if slot in held:
                for total, more in zip(held[slot], arrays):
                    total += more
            else:
                held[slot] = [a.copy() for a in arrays]
    return held


def summed(rows: DataFrame, tasks: int, slots: int, schema: str, finish) -> DataFrame:
    """Rows (slot, g, h) of whole numbers added up by slot, over many tasks in two steps, and finished."""
    def add(batches):
        held = sums_by_slot(batches)
        if held:
            yield histogram_rows(list(held), list(held.values()))

    if tasks > FAN:
        group = F.pmod(F.spark_partition_id(), F.lit(-(-tasks // FAN)))
        rows = rows.withColumn("group", group).repartition("slot", "group").drop("group").mapInArrow(add, HISTOGRAM)

    def run(batches):
        held = sums_by_slot(batches)
        if held:
            yield finish(held)

    return rows.repartition(-(-slots // SLOTS_A_TASK), "slot").mapInArrow(run, schema)


def best_split(g: np.ndarray, h: np.ndarray, starts: np.ndarray, usable: np.ndarray, s: Settings) -> tuple:
    """(feature, bin, gain, g, h, left g, left h) of one node; feature -1 if nothing is gained."""
    def quality(a, b):
        return soft(a, s.l1) ** 2 / np.maximum(b + s.l2, 1e-300)

    whole_g, whole_h = g[:starts[1]].sum(), h[:starts[1]].sum()
    left_g, left_h = np.cumsum(g), np.cumsum(h)
    before = np.repeat(np.concatenate([[0.0], left_g[starts[1:-1] - 1]]), np.diff(starts))
    left_g = left_g - before
    left_h = left_h - np.repeat(np.concatenate([[0.0], left_h[starts[1:-1] - 1]]), np.diff(starts))
    gain = 0.5 * (quality(left_g, left_h) + quality(whole_g - left_g, whole_h - left_h) - quality(whole_g, whole_h)) - s.least_gain
    allowed = np.repeat(usable, np.diff(starts)) & (left_h >= s.least_weight) & (whole_h - left_h >= s.least_weight)
    allowed[starts[1:] - 1] = False
    gain = np.where(allowed, gain, -np.inf)
    at = int(gain.argmax())
    if not gain[at] > 1e-9:
        return -1, 0, 0.0, whole_g, whole_h, 0.0, 0.0
    feature = int(np.searchsorted(starts, at, side="right") - 1)
    return feature, at - int(starts[feature]), float(gain[at]), whole_g, whole_h, float(left_g[at]), float(left_h[at])


def grown(codes: np.ndarray, g: np.ndarray, h: np.ndarray, starts: np.ndarray, usable: np.ndarray, s: Settings, scale: float) -> Growing:
    """One tree over rows that are all at hand, split for split the one that the jobs of `Fit.splits` grow."""
    tree, n, flat, most = Growing(), codes.shape[1], codes.ravel(), MERGED * BLOCK_ROWS
    node = np.zeros(n, np.int64)
    while wanted := tree.wanted(s):
        feature, cut, left, right = tree.routes()
        moving = np.flatnonzero(feature[node] >= 0)
        while len(moving):
            at = node[moving]
            at = np.where(flat[feature[at] * n + moving] > cut[at], right[at], left[at])
            node[moving] = at
            moving = moving[feature[at] >= 0]
        place = np.full(len(tree.nodes), -1, np.int64)
        place[wanted] = np.arange(len(wanted))
        slot = place[node]
        rows = np.flatnonzero(slot >= 0)
        sums = np.zeros((2, len(wanted), int(starts[-1])), np.int64)
        for a in range(0, len(rows), most):  # sums of that many rows stay below 2^53, so they are exact
            some = rows[a:a + most]
            for total, found in zip(sums, node_sums(codes[:, some], slot[some], (g[some], h[some]), len(wanted), starts)):
                total += found
        for i, a in enumerate(wanted):
            split = best_split(sums[0, i] / scale, sums[1, i] / scale, starts, usable, s)
            tree.nodes[a].know(*split)
    return tree


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Few rows to an Arrow batch, for tables whose rows are large; and a task for each table of a union."""
    wanted = {BATCH_CONF: str(BATCH_ROWS), READ_CONF: str(BATCH_ROWS), UNION_CONF: "false"}
    before = {c: spark.conf.get(c) for c in wanted}
    try:
        for c, value in wanted.items():
            spark.conf.set(c, value)
        yield
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)


class Fit:
    """One fit: the blocks, the trees grown since their margins were written, and the jobs over them."""

    def __init__(self, settings: Settings, bins: Bins, blocks: DataFrame, scale: float, n: int):
        self.settings, self.bins, self.scale = settings, bins, scale
        self.blocks, self.path = blocks.persist(), last_staged()
        self.fresh: list[tuple[int, tuple[np.ndarray, ...], np.ndarray]] = []
        self.tasks, self.whole = blocks.rdd.getNumPartitions(), n <= WHOLE_BLOCKS * BLOCK_ROWS

    def margins(self):
        """The margins of a block with the trees that are not in it yet."""
        fresh = self.fresh

        def now(codes, margin):
            margin = margin.copy()
            for output, routes, values in fresh:
                margin[output] += values[routed(codes, routes)]
            return margin

        return now

    def write_margins(self) -> None:
        outputs, now = self.settings.outputs, self.margins()

        def run(batches):
            for batch in batches:
                for codes, target, weight, draw, margin in blocks_of(batch, outputs):
                    yield packed(codes, target, weight, draw, now(codes, margin))

        written = stage(self.blocks.mapInArrow(run, _BLOCK), "margins")
        self.drop()
        self.blocks, self.path, self.fresh = written.persist(), last_staged(), []

    def drop(self) -> None:
        self.blocks.unpersist()
        discard(self.blocks.sparkSession, self.path)

    def derive(self, round_: int, bar: float | None):
        """Codes and scaled whole-number derivatives of the rows of a block that count: sampled ones, those over the bar always."""
        s, scale, now = self.settings, self.scale, self.margins()

        def derive(codes, target, weight, draw, margin):
            g, h = gradients(s, target, weight, now(codes, margin))
            if s.subsample >= 1 and bar is None:
                return codes, np.rint(g * scale), np.rint(h * scale)
            luck = drawn(draw, s.seed, round_)
            use = luck < s.subsample
            if bar is not None:
                size = np.abs(g).sum(axis=0)
                large = size >= bar
                use = large | (luck < s.other_share / (1 - s.top_share))
                factor = np.where(large, 1.0, (1 - s.top_share) / s.other_share)
                g, h = g * factor, h * factor
            return codes[:, use], np.rint(g * scale)[:, use], np.rint(h * scale)[:, use]

        return derive

    def trees(self, round_: int) -> list[Growing]:
        """One job grows the trees of all outputs, each in a task of its own."""
        s, starts, scale, derive = self.settings, self.bins.starts, self.scale, self.derive(round_, self.bar(round_))
        usable = [self.columns(round_, k) for k in range(s.outputs)]

        def grow(k):
            def run(batches):
                parts = [(codes, g[k], h[k]) for batch in batches for codes, g, h in (derive(*b) for b in blocks_of(batch, s.outputs))]
                codes, g, h = (np.concatenate(x, axis=-1) for x in zip(*parts))
                tree = grown(np.ascontiguousarray(codes), g, h, starts, usable[k], s, scale)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pickle.dumps(tree)], pa.binary())], ["output", "tree"])

            return run

        together, jobs = self.blocks.coalesce(1), None
        for k in range(s.outputs):
            one = together.mapInArrow(grow(k), "output int, tree binary")
            jobs = one if jobs is None else jobs.unionByName(one)
        # one row per output
        return [pickle.loads(r["tree"]) for r in sorted(jobs.collect(), key=lambda r: r["output"])]

    def derived(self, round_: int, bar: float | None) -> DataFrame:
        s, derive = self.settings, self.derive(round_, bar)

        def run(batches):
            for batch in batches:
                for block in merged((derive(*b) for b in blocks_of(batch, s.outputs)), MERGED):
                    values = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in block]
                    yield pa.RecordBatch.from_arrays(values, ["codes", "g", "h"])

        return self.blocks.mapInArrow(run, _DERIVED).persist()

    def bar(self, round_: int) -> float | None:
        """The size of gradient that `top_share` of the rows reach, to a 4096th of the largest possible one."""
        s = self.settings
        if s.top_share >= 1:
            return None
        whole, now, top = 4096, self.margins(), 2.0 ** 38 / self.scale

        def run(batches):
            counts = np.zeros(whole, np.int64)
            for batch in batches:
                for codes, target, weight, draw, margin in blocks_of(batch, s.outputs):
                    size = np.abs(gradients(s, target, weight, now(codes, margin))[0]).sum(axis=0)
                    counts += np.bincount(np.minimum(size / top * whole, whole - 1).astype(int), minlength=whole)
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(counts)), pa.array(counts[counts > 0])], ["level", "n"])

        rows = self.blocks.mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
        total, seen = sum(r["n"] for r in rows), 0
        for r in sorted(rows, key=lambda r: -r["level"]):  # at most 4096 levels
            seen += r["n"]
            if seen >= s.top_share * total:
                return r["level"] * top / whole
        return 0.0

    def splits(self, growing: list[Growing], wanted: list[list[int]], round_: int, derived: DataFrame) -> None:
        """One job finds the best splits of all wanted nodes of all outputs."""
        s, starts, outputs = self.settings, self.bins.starts, self.settings.outputs
        routes = [tree.routes() for tree in growing]
        slots = [(k, a) for k, nodes in enumerate(wanted) for a in nodes]
        place = [np.full(len(tree.nodes), -1, np.int64) for tree in growing]
        first = np.concatenate([[0], np.cumsum([len(nodes) for nodes in wanted])])
        for k, nodes in enumerate(wanted):
            place[k][nodes] = np.arange(len(nodes))
        width, scale = int(starts[-1]), self.scale
        usable = [self.columns(round_, k) for k in range(outputs)]
        features = len(starts) - 1

        def run(batches):
            sums = [np.zeros((2, len(nodes), width), np.int64) for nodes in wanted]
            for batch in batches:
                for row in zip(*[batch.column(c) for c in ("codes", "g", "h")]):
                    codes, g, h = (np.frombuffer(v.as_buffer(), t).reshape(n, -1) for v, t, n in zip(row, ("u1", "f8", "f8"), (features, outputs, outputs)))
                    for k, nodes in enumerate(wanted):
                        if not nodes or not codes.shape[1]:
                            continue
                        slot = place[k][routed(codes, routes[k])]
                        own, values = codes, (g[k], h[k])
                        if slot.min() < 0:
                            rows = np.flatnonzero(slot >= 0)
                            slot, own, values = slot[rows], codes[:, rows], [v[rows] for v in values]
                        # sums of that many rows stay below 2^53, so they are exact
                        for total, found in zip(sums[k], node_sums(own, slot, values, len(nodes), starts)):
                            total += found
            for k, nodes in enumerate(wanted):
                for i in range(0, len(nodes), SLOTS_A_TASK):
                    some = range(i, min(len(nodes), i + SLOTS_A_TASK))
                    yield histogram_rows([int(first[k]) + j for j in some], [sums[k][:, j] for j in some])

        owner = np.repeat(np.arange(outputs), np.diff(first))

        def finish(held):
            rows = [(slot, *best_split(g / scale, h / scale, starts, usable[owner[slot]], s)) for slot, (g, h) in held.items()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 5))], [c.split()[0] for c in _SPLIT.split(", ")])

        # one row per open node of the round's trees
        for r in summed(derived.mapInArrow(run, HISTOGRAM), self.tasks, len(slots), _SPLIT, finish).collect():
            k, at = slots[r["slot"]]
            growing[k].nodes[at].know(*[r[c] for c in ("feature", "bin", "gain", "g", "h", "left_g", "left_h")])

    def columns(self, round_: int, output: int) -> np.ndarray:
        """The features a tree may use."""
        n = len(self.bins.cuts)
        chosen = max(1, round(self.settings.column_share * n))
        usable = np.zeros(n, bool)
        usable[np.random.default_rng([self.settings.seed, round_, output]).permutation(n)[:chosen]] = True
        return usable

    def round(self, round_: int) -> list[Tree]:
        """Grow one tree per output."""
        s = self.settings
        if self.whole:
            growing = self.trees(round_)
        else:
            growing, derived = [Growing() for _ in range(s.outputs)], self.derived(round_, self.bar(round_))
            try:
                while any(wanted := [tree.wanted(s) for tree in growing]):
                    self.splits(growing, wanted, round_, derived)
            finally:
                derived.unpersist()
        trees = []
        for k, tree in enumerate(growing):
            routes, values, cover = tree.finished(s, lambda g, h: -s.rate * float(soft(g, s.l1)) / max(h + s.l2, 1e-300))
            self.fresh.append((k, routes, values))
            feature, cut = routes[:2]
            cuts = np.array([self.bins.cuts[f][b] if f >= 0 else 0.0 for f, b in zip(feature, cut)])
            out = np.zeros((len(values), s.outputs))
            out[feature < 0, k] = values[feature < 0]
            trees.append(Tree(feature, cuts, routes[2], routes[3], out, cover))
        if (round_ + 1) % ROUNDS_HELD == 0 and round_ + 1 < s.rounds:
            self.write_margins()
        return trees


def fit_trees(rows: DataFrame, settings: Settings) -> tuple[list[Tree], np.ndarray]:
    """Trees and the margin every row begins with, from rows (x array<double>, target double, weight double).

    Bins come from about SAMPLE rows that a hash of the row chooses, all rows while there are no more; up to `bins`
    distinct values have a bin each. NaN falls into the last bin, hence to the right of every split.
    """
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("w"), F.min("target").alias("low"),
                     F.max("target").alias("high"), F.round(F.sum(F.col("target") * F.col("weight")) / F.sum("weight"), 9).alias("mean")).first()
    if not about["n"]:
        raise ValueError("there are no rows to fit")
    hashed = rows.withColumn("draw", F.xxhash64("x", "target"))
    share = min(1.0, SAMPLE / about["n"])
    sampled = hashed.where((F.shiftrightunsigned("draw", 24) / F.lit(2.0**40)) < F.lit(share)) if share < 1 else hashed
    columns = sampled.select("x").toArrow().column("x").combine_chunks()
    values = columns.flatten().to_numpy(zero_copy_only=False)
    bins = Bins.fit(values.reshape(len(columns), -1), settings.bins)
    start = np.full(settings.outputs, about["mean"] if settings.objective == SQUARED else 0.0)
    bound = about["w"] * (1.0 if settings.objective == SOFTMAX else max(1e-6, 4 * (about["high"] - about["low"])))
    if settings.top_share < 1:
        bound *= max(1.0, (1 - settings.top_share) / settings.other_share) * settings.outputs
    bits = int(np.ceil(np.log2(bound)))
    scale = 2.0 ** min(38 - bits, 62 - bits - int(np.ceil(np.log2(about["n"] + 1))))

    def pack(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                target, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("target", "weight"))
                draw = batch.column("draw").to_numpy(zero_copy_only=False).view(np.uint64)
                for a in range(0, n, BLOCK_ROWS):
                    b = min(n, a + BLOCK_ROWS)
                    yield packed(bins.codes(x[a:b]), target[a:b], weight[a:b], draw[a:b], np.repeat(start[:, None], b - a, axis=1))

    # every task sends histograms of all nodes, so tasks are large, and as many as fill the cores
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = min(max(1, about["n"] // BLOCK_ROWS), -(-max(1, about["n"] // TASK_ROWS) // cores) * cores)
    blocks = stage(hashed.mapInArrow(pack, _BLOCK).repartition(int(parts)), "blocks")
    rows.unpersist()  # the blocks stand for them
    trees = []
    with small_batches(rows.sparkSession):
        fit = Fit(settings, bins, blocks, scale, about["n"])
        try:
            for round_ in range(settings.rounds):
                trees += fit.round(round_)
        finally:
            fit.drop()
    return trees, start


class _BoosterParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    objective = Param(Params._dummy(), "objective", "softmax or squared", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes, coded from 0", TypeConverters.toInt)
    rounds = Param(Params._dummy(), "rounds", "boosting rounds", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "largest tree depth", TypeConverters.toInt)
    leaves = Param(Params._dummy(), "leaves", "most leaves, grown best first; 0 grows by level", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "learning rate", TypeConverters.toFloat)
    l1 = Param(Params._dummy(), "l1", "absolute penalty of leaf values", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "squared penalty of leaf values", TypeConverters.toFloat)
    leastGain = Param(Params._dummy(), "leastGain", "gain a split must exceed", TypeConverters.toFloat)
    leastWeight = Param(Params._dummy(), "leastWeight", "least curvature per child", TypeConverters.toFloat)
    subsample = Param(Params._dummy(), "subsample", "share of rows per round", TypeConverters.toFloat)
    columnShare = Param(Params._dummy(), "columnShare", "share of features per tree", TypeConverters.toFloat)
    topShare = Param(Params._dummy(), "topShare", "share of rows of largest gradient that all count; 1 for all", TypeConverters.toFloat)
    otherShare = Param(Params._dummy(), "otherShare", "share of rows drawn from the others", TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "most bins per feature, up to 256", TypeConverters.toInt)
    weightCol = Param(Params._dummy(), "weightCol", "row weight, empty for none", TypeConverters.toString)


_DEFAULTS = dict(
    objective=SOFTMAX, classes=4, rounds=500, depth=6, leaves=0, rate=0.1, l1=0.0, l2=1.0, leastGain=0.0, leastWeight=1.0,
    subsample=1.0, columnShare=1.0, topShare=1.0, otherShare=0.0, bins=256, weightCol="", seed=SEED,
)


class HistogramBooster(Estimator, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees over the cross entropy of classes coded from 0, or over squared error."""

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
        objective=SOFTMAX, classes=4, rounds=500, depth=6, leaves=0, rate=0.1, l1=0.0, l2=1.0, leastGain=0.0, leastWeight=1.0,
        subsample=1.0, columnShare=1.0, topShare=1.0, otherShare=0.0, bins=256, weightCol="", seed=SEED,
    ):
        super().__init__()
        self._setDefault(**_DEFAULTS)
        self._set(**self._input_kwargs)

    def settings(self) -> Settings:
        get = self.getOrDefault
        if not 2 <= get("bins") <= 256:
            raise ValueError("bins must be 2 to 256")
        if get("objective") not in (SOFTMAX, SQUARED):
            raise ValueError(f"no objective {get('objective')}")
        if get("topShare") < 1 and not 0 < get("otherShare") <= 1 - get("topShare"):
            raise ValueError("otherShare must be above 0 and at most what topShare leaves")
        return Settings(
            get("objective"), get("classes"), get("rounds"), get("depth"), get("leaves"), get("rate"), get("l1"), get("l2"),
            get("leastGain"), get("leastWeight"), get("subsample"), get("columnShare"), get("topShare"), get("otherShare"),
            get("bins"), get("seed"))

    def _fit(self, dataset: DataFrame) -> HistogramBoosterModel:
        get = self.getOrDefault
        weight = F.col(get("weightCol")).cast("double") if get("weightCol") else F.lit(1.0)
        rows = dataset.select(vector_to_array(F.col(get("featuresCol"))).alias("x"),
                              F.col(get("labelCol")).cast("double").alias("target"), weight.alias("weight")).persist()
        try:
            trees, start = fit_trees(rows, self.settings())
        finally:
            rows.unpersist()
        return self._copyValues(HistogramBoosterModel(trees, start))


class HistogramBoosterModel(Model, _BoosterParams, MLReadable, MLWritable):
    def __init__(self, trees: list[Tree] | None = None, start: np.ndarray | None = None):
        super().__init__()
        self._setDefault(**_DEFAULTS)
        self.trees, self.start = trees or [], np.zeros(1) if start is None else start

    def copy(self, extra=None) -> HistogramBoosterModel:
        other = super().copy(extra)
        other.trees, other.start = self.trees, self.start
        return other

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sent = dataset.sparkSession.sparkContext.broadcast((self.trees, self.start))
        softmax = self.getOrDefault("objective") == SOFTMAX

        @F.arrow_udf("array<double>")
        def outputs(column: pa.Array) -> pa.Array:
            trees, start = sent.value
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
            out = score(trees, x) + start
            if softmax:
                out = np.exp(out - out.max(axis=1, keepdims=True))
                out /= out.sum(axis=1, keepdims=True)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))

        scored = dataset.withColumn("_outputs", outputs(vector_to_array(F.col(self.getOrDefault("featuresCol")))))
        prediction = self.getOrDefault("predictionCol")
        if not softmax:
            return scored.withColumn(prediction, F.get("_outputs", F.lit(0))).drop("_outputs")
        return scored.withColumns({
            prediction: argmax(F.col("_outputs")).cast("double"),
            self.getOrDefault("probabilityCol"): array_to_vector(F.col("_outputs")),
        }).drop("_outputs")

    def write(self) -> MLWriter:
        return _BoosterWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BoosterReader(cls)


def tree_rows(spark: SparkSession, trees: list[Tree]) -> DataFrame:
    """A row of arrays per tree."""
    rows = [(i, t.feature.tolist(), t.cut.tolist(), t.left.tolist(), t.right.tolist(), t.value.ravel().tolist(), t.cover.tolist())
            for i, t in enumerate(trees)]
    return spark.createDataFrame(
        rows, "tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, value array<double>, cover array<double>")


def trees_from(rows: DataFrame, outputs: int) -> list[Tree]:
    return [Tree(np.array(r["feature"]), np.array(r["cut"]), np.array(r["left"]), np.array(r["right"]),
                 np.array(r["value"]).reshape(-1, outputs), np.array(r["cover"])) for r in rows.orderBy("tree").collect()]


class _BoosterWriter(MLWriter):
    def __init__(self, instance: HistogramBoosterModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(self.instance, path, spark, extraMetadata={"start": self.instance.start.tolist()})
        tree_rows(spark, self.instance.trees).write.parquet(f"{path}/trees")


class _BoosterReader(MLReader):
    def __init__(self, cls: type[HistogramBoosterModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> HistogramBoosterModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        start = np.array(metadata["start"])
        model = self.cls(trees_from(spark.read.parquet(f"{path}/trees"), len(start)), start)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
