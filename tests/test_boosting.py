"""Histogram boosting against a booster that tries every threshold, and Shapley values against all coalitions."""

import heapq
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from acreage.ml import boosting as B
from acreage.ml.boosting import HistogramBooster, HistogramBoosterModel
from acreage.ml.trees import Paths, Tree, expectation, score
from acreage.session import shared_dir


def data(n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.uniform(-2, 2, n), rng.integers(0, 3, n), np.where(rng.random(n) < 0.3, 1.0, 0.0)])
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * x[:, 2] + rng.normal(0, 0.3, n))
    return x, np.digitize(y, [0.2, 0.9, 1.6]).astype(float), y


def table(spark, x, y, weight=None):
    rows = [(i, [float(v) for v in a], float(b), float(w)) for i, (a, b, w) in
            enumerate(zip(x, y, weight if weight is not None else np.ones(len(y))))]
    df = spark.createDataFrame(rows, "id long, x array<double>, label double, w double")
    return df.withColumn("features", array_to_vector("x")).drop("x")


def soft(g, l1):
    return math.copysign(max(abs(g) - l1, 0), g)


def tried(x, g, h, rows, l1, l2, least, floor):
    """The best split of some rows: every feature, every value between two rows."""
    def quality(a, b):
        return soft(a, l1) ** 2 / (b + l2)

    best = None
    for f in range(x.shape[1]):
        for low, high in itertools.pairwise(np.unique(x[:, f])):  # all values of the table, as bins are
            cut = (low + high) / 2
            left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
            if min(h[left].sum(), h[right].sum()) < least or not len(left) or not len(right):
                continue
            gain = (quality(g[left].sum(), h[left].sum()) + quality(g[right].sum(), h[right].sum())
                    - quality(g[rows].sum(), h[rows].sum())) / 2 - floor
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                best = (gain, f, cut, left, right)
    return best


def brute(x, y, rounds, depth=3, leaves=0, rate=0.3, l1=0.0, l2=1.0, least=1.0, floor=0.0, weight=None, classes=4):
    """Margins of a booster without histograms; by level, or best leaf first."""
    weight = np.ones(len(y)) if weight is None else weight
    margin = np.zeros((len(y), classes))
    if classes == 1:
        margin += round((y * weight).sum() / weight.sum(), 9)
    for _ in range(rounds):
        p = np.exp(margin - margin.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        step = np.zeros_like(margin)
        for k in range(classes):
            g, h = ((margin[:, 0] - y) * weight, weight) if classes == 1 else (
                (p[:, k] - (y == k)) * weight, 2 * p[:, k] * (1 - p[:, k]) * weight)
            done, heap, serial = [], [], itertools.count()

            def offer(rows, deep):
                found = tried(x, g, h, rows, l1, l2, least, floor) if leaves or deep < depth else None
                if found is None:
                    done.append(rows)
                else:
                    heapq.heappush(heap, (-found[0] if leaves else deep, next(serial), found, rows, deep))

            offer(np.arange(len(y)), 0)
            while heap and not (leaves and len(heap) + len(done) >= leaves):
                *_, found, _, deep = heapq.heappop(heap)
                offer(found[3], deep + 1)
                offer(found[4], deep + 1)
            for rows in [*done, *[e[3] for e in heap]]:
                step[rows, k] = -rate * soft(g[rows].sum(), l1) / (h[rows].sum() + l2)
        margin += step
    return margin


def margins(model, df):
    x = np.array([r[0] for r in df.orderBy("id").select(vector_to_array("features")).collect()])
    return score(model.trees, x) + model.start


@pytest.mark.parametrize("options", [
    {"rounds": 9, "depth": 3}, {"rounds": 3, "depth": 5, "l1": 0.4, "l2": 3.0, "least": 4.0, "floor": 0.2},
    {"rounds": 3, "leaves": 9}])
def test_softmax_booster_equals_one_without_histograms(spark, options):
    x, y, _ = data()
    weight = np.random.default_rng(1).uniform(0.5, 2, len(y))
    names = {"least": "leastWeight", "floor": "leastGain"}
    learner = HistogramBooster(rate=0.3, bins=256, weightCol="w", **{names.get(k, k): v for k, v in options.items()})
    # fewer values than bins, so that every value is a bin
    coarse = np.column_stack([np.round(x[:, 0] * 12) / 12, np.round(x[:, 1] * 20) / 20, x[:, 2:]])
    df = table(spark, coarse, y, weight)
    want = brute(coarse, y, weight=weight, **options)
    got = margins(learner.fit(df), df)
    assert np.allclose(got, want, atol=1e-6)
    if options.get("leaves"):
        assert max(int((t.feature < 0).sum()) for t in learner.fit(df).trees) == options["leaves"]


def test_squared_booster_equals_one_without_histograms(spark):
    x, _, y = data()
    x = np.round(x * 10) / 10
    model = HistogramBooster(objective="squared", rounds=8, depth=4, rate=0.3).fit(table(spark, x, y))
    df = table(spark, x, y)
    want = brute(x, y, 8, depth=4, classes=1)
    assert np.allclose(margins(model, df), want, atol=1e-6)
    got = [r.prediction for r in model.transform(df).orderBy("id").collect()]
    assert np.allclose(got, want[:, 0], atol=1e-6)


def test_one_model_for_any_layout(spark, monkeypatch):
    x, y, _ = data(400)
    df = table(spark, x, y)
    options = dict(rounds=5, depth=3, bins=32, subsample=0.7, columnShare=0.5, rate=0.2)

    def fitted(frame):
        return margins(HistogramBooster(**options).fit(frame), df)

    whole = fitted(df.repartition(1))
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)  # many blocks and tasks
    monkeypatch.setattr(B, "FAN", 3)
    assert (fitted(df.repartition(7)) == whole).all()
    monkeypatch.setattr(B, "ROUNDS_HELD", 2)
    assert np.allclose(fitted(df), whole, atol=1e-12)


def test_gradient_sampling_keeps_the_large_ones(spark):
    x, y, _ = data(400)
    df = table(spark, x, y)
    model = HistogramBooster(rounds=8, leaves=5, topShare=0.3, otherShare=0.3, rate=0.2).fit(df)
    full = HistogramBooster(rounds=8, leaves=5, rate=0.2).fit(df)
    rows = model.transform(df).select("label", "prediction").collect()
    assert sum(r.label == r.prediction for r in rows) / len(rows) > 0.75
    assert not np.allclose(margins(model, df), margins(full, df))
    with pytest.raises(ValueError):
        HistogramBooster(topShare=0.5).settings()


def test_model_survives_saving_and_odd_values(spark, tmp_path):
    x, y, _ = data(200)
    x[:5, 0] = np.nan
    x[5:9, 1] = np.inf
    df = table(spark, x, y)
    model = HistogramBooster(rounds=3, depth=3).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = HistogramBoosterModel.load(str(tmp_path / "m"))
    a, b = ([(r.prediction, list(r.probability)) for r in m.transform(df).orderBy("id").collect()] for m in (model, again))
    assert a == b and all(abs(sum(p) - 1) < 1e-9 and np.argmax(p) == c for c, p in a)
    with pytest.raises(ValueError):
        HistogramBooster(rounds=1).fit(df.limit(0))
    lone = table(spark, np.ones((3, 1)), [0.0, 0.0, 1.0])  # nothing to split by
    assert HistogramBooster(rounds=2).fit(lone).transform(lone).count() == 3


def test_a_fit_leaves_no_tables_behind(spark):
    x, y, _ = data(60)
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def tables():
        return {str(s.getPath()) for s in files.listStatus(path)}

    before = tables()
    HistogramBooster(rounds=9, depth=1).fit(table(spark, x, y))
    assert tables() == before


def value_of(tree, x, known, node=0):
    f = int(tree.feature[node])
    if f < 0:
        return tree.value[node]
    children = (tree.left[node], tree.right[node])
    if f in known:
        return value_of(tree, x, known, children[0] if x[f] <= tree.cut[node] else children[1])
    return sum(tree.cover[c] / tree.cover[node] * value_of(tree, x, known, c) for c in children)


def all_coalitions(trees, x):
    """Shapley values of one row by enumerating the subsets of its features."""
    n = len(x)
    worth = {s: sum(value_of(t, x, set(s)) for t in trees) for r in range(n + 1) for s in itertools.combinations(range(n), r)}
    out = []
    for i in range(n):
        out.append(sum(
            math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (worth[tuple(sorted((*s, i)))] - worth[s])
            for s in worth if i not in s))
    return np.array(out)


def grown(rng, features, depth, outputs):
    """A random tree whose paths may use a feature twice."""
    rows = []

    def grow(level, cover):
        at = len(rows)
        rows.append(None)
        if level == depth or rng.random() < 0.15:
            rows[at] = (-1, 0.0, 0, 0, rng.normal(size=outputs), cover)
        else:
            part = cover * rng.uniform(0.05, 0.95)
            left = grow(level + 1, part)
            rows[at] = (int(rng.integers(features)), float(rng.normal()), left, grow(level + 1, cover - part), np.zeros(outputs), cover)
        return at

    grow(0, 100.0)
    return Tree(*[np.array(c) for c in zip(*rows)])


def test_path_values_equal_all_coalitions():
    rng = np.random.default_rng(0)
    trees = [grown(rng, 6, depth, 2) for depth in (0, 1, 3, 6, 8)]
    x = rng.normal(size=(7, 6))
    got = Paths(trees).shapley(x, 2)
    for row, values in zip(x, got):
        assert np.allclose(values, all_coalitions(trees, row), atol=1e-10)
    assert np.allclose(got.sum(axis=1), score(trees, x) - expectation(trees), atol=1e-10)


def test_a_task_holds_many_blocks(spark, monkeypatch):
    x, y, _ = data(400)
    seen, summed = [], B.summed
    monkeypatch.setattr(B, "BLOCK_ROWS", 10)

    def noted(rows, tasks, *others):
        seen.append(tasks)
        return summed(rows, tasks, *others)

    monkeypatch.setattr(B, "summed", noted)
    HistogramBooster(rounds=1, depth=2).fit(table(spark, x, y))
    assert seen and max(seen) <= spark.sparkContext.defaultParallelism


def test_sums_per_node_equal_plain_loops():
    rng = np.random.default_rng(2)
    starts = np.array([0, 1, 3, 12])
    codes = np.array([np.zeros(50), rng.integers(0, 2, 50), rng.integers(0, 9, 50)], np.uint8)
    slot, values = rng.integers(0, 4, 50), rng.integers(-99, 99, (2, 50)).astype(float)
    want = np.zeros((2, 4, 12))
    for i in range(50):
        for f in range(3):
            want[:, slot[i], starts[f] + codes[f, i]] += values[:, i]
    assert (np.array(B.node_sums(codes, slot, tuple(values), 4, starts)) == want).all()


@pytest.mark.parametrize("options", [{"depth": 4}, {"leaves": 12}, {"depth": 3, "topShare": 0.3, "otherShare": 0.2}])
def test_trees_grown_in_a_task_equal_those_grown_by_jobs(spark, monkeypatch, options):
    x, y, _ = data(400)
    df, jobs, splits = table(spark, x, y), [], B.Fit.splits
    monkeypatch.setattr(B.Fit, "splits", lambda self, *a: jobs.append(1) or splits(self, *a))

    def fitted():
        jobs.clear()
        model = HistogramBooster(rounds=2, **options).fit(df)
        return [tuple(v.tolist() for v in (t.feature, t.cut, t.value, t.cover)) for t in model.trees], len(jobs)

    whole, none = fitted()
    monkeypatch.setattr(B, "WHOLE_BLOCKS", 0)
    spread, some = fitted()
    assert whole == spread and none == 0 < some


def test_rows_of_blocks_come_in_small_batches(spark, monkeypatch):
    x, y, _ = data(400)
    monkeypatch.setattr(B, "BLOCK_ROWS", 5)
    monkeypatch.setattr(B, "BATCH_ROWS", 3)
    monkeypatch.setattr(B, "MERGED", 1)
    sizes, before = spark.sparkContext.accumulator(0), spark.conf.get(B.BATCH_CONF)
    plain = B.sums_by_slot

    def noted(batches):
        def counted():
            for batch in batches:
                sizes.add(max(0, batch.num_rows - 3))
                yield batch

        return plain(counted())

    monkeypatch.setattr(B, "sums_by_slot", noted)
    monkeypatch.setattr(B, "SLOTS_A_TASK", 64)
    model = HistogramBooster(rounds=1, depth=3).fit(table(spark, x, y).repartition(1))
    assert len(model.trees) == 4 and sizes.value == 0 and spark.conf.get(B.BATCH_CONF) == before


def test_train_boosters_runs_the_published_rounds(spark, monkeypatch):
    import query_registry as Q

    asked = {}
    monkeypatch.setattr(Q, "_parts", lambda spark, folder: (None, None))
    monkeypatch.setattr(Q.T, "train_classifiers", lambda train, test, pipelines: asked.update(pipelines) or type("T", (), {"metrics": spark.range(1)}))
    Q.train_boosters(spark, "")
    boosters = {n: p.model if n == "ordered" else p.getStages()[-1] for n, p in asked.items()}
    assert {n: b.getOrDefault("rounds") for n, b in boosters.items()} == dict.fromkeys(("by_level", "best_first", "ordered"), 500)
    assert boosters["best_first"].getOrDefault("leaves") == 63 and boosters["by_level"].getOrDefault("depth") == 6
