"""Attributions of fitted tree models against all coalitions, and the search against a random one."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from acreage.ml import search as S
from acreage.ml.attributions import raw_names, tree_attributions, tree_outputs, trees_of
from acreage.ml.boosting import HistogramBooster
from acreage.operators.explain import kernel_attributions, kernel_coalitions, linear_attributions
from tests.test_boosting import all_coalitions

NAMES = ["a", "b", "c", "d", "e", "f"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 6)).round(2)
    y = x[:, 0] * x[:, 1] + np.abs(x[:, 2]) + (x[:, 3] > 0)
    return spark.createDataFrame([(i, *map(float, a), float(b), float(b > 1)) for i, (a, b) in enumerate(zip(x, y))],
                                 "id long, " + ", ".join(f"{n} double" for n in NAMES) + ", y double, label double").cache()


MODELS = {
    "forest": lambda: RandomForestClassifier(numTrees=4, maxDepth=5, seed=1),
    "tree": lambda: DecisionTreeClassifier(maxDepth=4),
    "forest_of_numbers": lambda: RandomForestRegressor(labelCol="y", numTrees=3, maxDepth=4, seed=1),
    "boosted_numbers": lambda: GBTRegressor(labelCol="y", maxIter=4, maxDepth=3),
    "histograms": lambda: HistogramBooster(classes=2, rounds=3, depth=3),
    "histograms_of_numbers": lambda: HistogramBooster(objective="squared", labelCol="y", rounds=3, leaves=6),
}


@pytest.mark.parametrize("name", MODELS)
def test_values_equal_all_coalitions_and_add_up(spark, rows, name):
    model = MODELS[name]()
    fitted = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), model]).fit(rows)
    values, mean = tree_attributions(rows, "id", fitted, NAMES, max_samples=12)
    found = {(r.row_id, r.output, r.feature): r.value for r in values.collect()}
    ids = sorted({i for i, *_ in found})
    assert len(ids) == 12 and len(found) == 12 * 6 * len(mean)
    trees, _ = trees_of(fitted.stages[-1])
    outputs = {r.row_id: r.outputs for r in tree_outputs(rows, "id", fitted).collect()}
    raw = {r.id: [r[n] for n in NAMES] for r in rows.collect()}
    for i in ids:
        for k in range(len(mean)):
            assert math.isclose(sum(found[i, k, n] for n in NAMES), outputs[i][k] - mean[k], abs_tol=1e-9)
    for i in ids[:2]:
        want = all_coalitions(trees, np.array(raw[i]))
        assert np.allclose([[found[i, k, n] for k in range(len(mean))] for n in NAMES], want, atol=1e-9)
    scored = fitted.transform(rows)
    if name in ("forest", "tree"):
        got = {r.id: list(r.probability) for r in scored.select("id", "probability").collect()}
        assert all(np.allclose(outputs[i], got[i]) for i in ids)
    elif model.getLabelCol() == "y":
        got = {r.id: r.prediction for r in scored.select("id", "prediction").collect()}
        assert all(math.isclose(outputs[i][0], got[i], abs_tol=1e-9) for i in ids)


def test_only_trees_are_explained(spark, rows):
    fitted = LogisticRegression().fit(VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows))
    with pytest.raises(TypeError):
        trees_of(fitted)
    tree = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), DecisionTreeClassifier(maxDepth=1)]).fit(rows)
    assert tree_attributions(rows.limit(0), "id", tree, NAMES)[0].count() == 0
    assert tree_attributions(rows, "id", tree, NAMES, max_samples=None)[0].count() == 300 * 6 * 2


def test_one_hot_places_may_split_either_way(spark, rows):
    named = rows.withColumn("kind", F.when(F.col("a") > 0.4, "x").when(F.col("b") > 0, "y").otherwise("z"))
    fitted = Pipeline(stages=[
        StringIndexer(inputCol="kind", outputCol="kind_ix"), OneHotEncoder(inputCol="kind_ix", outputCol="kind_oh", dropLast=False),
        VectorAssembler(inputCols=["kind_oh", "c"], outputCol="features"), RandomForestRegressor(labelCol="y", numTrees=5, maxDepth=5, seed=1),
    ]).fit(named)
    got = {r.row_id: r.outputs[0] for r in tree_outputs(named, "id", fitted).collect()}
    assert all(math.isclose(got[r.id], r.prediction, abs_tol=1e-9) for r in fitted.transform(named).select("id", "prediction").collect())
    values, _ = tree_attributions(named, "id", fitted, ["kind", "c"], max_samples=5)
    assert {r.feature for r in values.collect()} == {"kind", "c"}


def test_raw_names():
    assert raw_names(["zone_BEDS_z", "zone_TYPE_oh_house", "zone_PROPERTY_TYPE_te", "other"], ["BEDS", "TYPE", "PROPERTY_TYPE"]) == [
        "BEDS", "TYPE", "PROPERTY_TYPE", "other"]


SPACE = {"x": S.Real(1e-4, 1e2, log=True), "y": S.Real(-5, 5), "n": S.Whole(10, 100, 10), "noise": S.Real(0, 1)}


def hill(p, fold=0):
    return -((math.log10(p["x"]) + 1) ** 2 + (p["y"] - 2) ** 2 / 4 + ((p["n"] - 70) / 30) ** 2) - 0.01 * fold


def test_search_beats_a_random_one_at_equal_fits():
    def best(startup, seed):
        return max(t.score for t in S.search(SPACE, hill, 50, 1, seed, startup))

    led, blind = ([best(startup, seed) for seed in range(15)] for startup in (S.STARTUP, 50))
    assert np.mean(led) > np.mean(blind) and np.median(led) > np.median(blind)
    assert sum(a > b for a, b in zip(led, blind)) >= 10


def test_search_is_the_same_for_a_seed_and_stays_in_its_ranges():
    runs = [[(t.parameters, t.scores) for t in S.search(SPACE, hill, 30, 3, 7)] for _ in range(2)]
    assert runs[0] == runs[1]
    for p, _ in runs[0]:
        assert 1e-4 <= p["x"] <= 1e2 and -5 <= p["y"] <= 5 and p["n"] in range(10, 101, 10)
    assert S.search(SPACE, hill, 5, 1, 8)[0].parameters != runs[0][0][0]


def test_weak_trials_end_early_and_never_win():
    calls = []

    def evaluate(p, fold):
        calls.append(fold)
        return hill(p, fold)

    done = S.search(SPACE, evaluate, 40, 5, 3)
    stopped = [t for t in done if t.stopped]
    assert stopped and len(calls) == sum(len(t.scores) for t in done) < 200
    assert all(len(t.scores) < 5 for t in stopped) and not S.ranked(done)[0].stopped
    assert not any(t.stopped for t in done[:S.WARM])


def test_places_go_there_and_back():
    rng = random.Random(1)
    for kind in (S.Whole(3, 10), S.Whole(200, 1000, 100), S.Whole(4, 4), S.Real(1e-8, 10, log=True), S.Real(0.6, 1)):
        for _ in range(50):
            value = kind.value(rng.random())
            again = kind.value(min(kind.place(value), 1 - 1e-12))
            assert again == pytest.approx(value) and kind.low <= value <= kind.high
    density = S.Density([0.2, 0.2, 0.9])
    total = sum(math.exp(density.log((i + 0.5) / 1000)) for i in range(1000)) / 1000
    assert total == pytest.approx(1, abs=1e-3)


def by_feature(found):
    return {(r["row_id"], r["feature"]): r["value"] for r in found.collect()}


def test_kernel_form_equals_all_coalitions(spark, rows):
    """Mean over the background of the exact values of a score with products and a step, nulls included."""
    names = NAMES[:4]
    few = rows.filter("id < 12").select("id", *names).union(spark.sql("SELECT 99L, 1.0D, NULL, 2.0D, -1.0D"))

    def score(d):
        return d.withColumn("score", F.col("a") * F.coalesce("b", F.lit(0.5)) + F.abs("c") * F.col("a") + (F.col("d") > 0).cast("double"))

    def worth(x):
        return x[0] * (0.5 if x[1] is None else x[1]) + abs(x[2]) * x[0] + (x[3] > 0)

    got = by_feature(kernel_attributions(few, "id", names, score))
    table = {r["id"]: [r[n] for n in names] for r in few.collect()}
    assert len(got) == 4 * len(table)
    for key, x in table.items():
        for i, name in enumerate(names):
            want = 0.0
            for mask in range(16):
                if mask >> i & 1:
                    continue
                size = mask.bit_count()
                part = math.factorial(size) * math.factorial(3 - size) / 24
                with_i, without = mask | 1 << i, mask
                mean = sum(worth([x[j] if with_i >> j & 1 else o[j] for j in range(4)]) - worth([x[j] if without >> j & 1 else o[j] for j in range(4)])
                           for o in table.values()) / len(table)
                want += part * mean
            assert got[key, name] == pytest.approx(want, abs=1e-9)


def test_kernel_form_of_a_linear_score_is_linear(spark, rows):
    """Also with drawn coalitions, and for one feature; an empty table has no values."""
    score = lambda d: d.withColumn("score", sum(((k + 1) * F.col(n) for k, n in enumerate(NAMES)), F.lit(3.0)))
    few = rows.filter("id < 15").select("id", *NAMES)
    want = by_feature(linear_attributions(few, "id", {n: k + 1.0 for k, n in enumerate(NAMES)}))
    got = by_feature(kernel_attributions(few, "id", NAMES, score, coalitions=24))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    one = by_feature(kernel_attributions(few, "id", ["c"], lambda d: d.withColumn("score", 3.0 * F.col("c"))))
    assert all(v == pytest.approx(want[k], abs=1e-9) for k, v in one.items()) and len(one) == 15
    assert kernel_attributions(few.limit(0), "id", NAMES, score).count() == 0
    assert kernel_coalitions(12, 60) == kernel_coalitions(12, 60) and len(kernel_coalitions(2, 1)) == 4
    with pytest.raises(ValueError):
        kernel_coalitions(63, 10)


def test_explained_queries_average_over_every_test_row(spark, rows, monkeypatch):
    import query_registry as Q

    test = rows.crossJoin(spark.range(3).withColumnRenamed("id", "copy")).select(
        (F.col("id") * 3 + F.col("copy")).alias("LISTING_ID"), *[(F.col(n) + 0.3 * F.col("copy")).alias(n) for n in NAMES])
    monkeypatch.setattr(Q, "_parts", lambda spark, folder: (rows, test))
    monkeypatch.setattr(Q, "ALL_FEATURES", NAMES)
    model = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), HistogramBooster(classes=2, rounds=3, depth=3)])
    got = {(r.output, r.feature): r.mean_abs for r in Q._explained(spark, "", model).collect()}
    values, _ = tree_attributions(test, "LISTING_ID", model.fit(rows), NAMES, max_samples=None)
    assert values.select("row_id").distinct().count() == 900
    want = values.groupBy("output", "feature").agg(F.avg(F.abs("value")).alias("mean_abs")).collect()
    assert len(got) == len(want) == 12 and all(got[r.output, r.feature] == pytest.approx(r.mean_abs, abs=1e-6) for r in want)
