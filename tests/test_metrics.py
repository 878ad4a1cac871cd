import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.operators import metrics as E, thresholds as H


def frame(spark, truth, pred, groups=None):
    groups = groups or [None] * len(truth)
    return spark.createDataFrame(list(zip(truth, pred, groups)), "t int, p int, g string")


def test_classifier_metrics(spark):
    df = frame(spark, [0, 1, 2, 0, 1, 2, 0, 1], [0, 1, 2, 0, 2, 2, 1, 1])
    row = E.evaluate_classifier(df, "t", "p").first()
    assert row["accuracy"] == 0.75 and row["n"] == 8
    f1 = [0.8, 2 / 3, 0.8]
    assert row["macro_f1"] == pytest.approx(sum(f1) / 3)
    assert row["weighted_f1"] == pytest.approx((3 * 0.8 + 3 * 2 / 3 + 2 * 0.8) / 8)
    chance = (3 * 2 + 3 * 3 + 2 * 3) / 64
    assert row["cohen_kappa"] == pytest.approx((0.75 - chance) / (1 - chance))
    assert {(r["y_true"], r["y_pred"]): r["n"] for r in E.confusion(df, "t", "p").collect()}[2, 2] == 2


def test_labels_seen_only_in_predictions_count(spark):
    row = E.evaluate_classifier(frame(spark, [0, 0], [0, 3]), "t", "p").first()
    assert row["macro_f1"] == pytest.approx((2 / 3) / 2)


def test_perfect_and_single_class(spark):
    row = E.evaluate_classifier(frame(spark, [0, 1], [0, 1]), "t", "p").first()
    assert row["accuracy"] == row["macro_f1"] == row["cohen_kappa"] == 1
    assert E.evaluate_classifier(frame(spark, [1, 1], [1, 1]), "t", "p").first()["cohen_kappa"] is None


def test_class_report_rows(spark):
    df = frame(spark, [0, 1, 2, 0], [0, 1, 1, 0])
    rows = {r["label"]: r for r in E.class_report(df, "t", "p").collect()}
    assert set(rows) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert rows["2"]["f1"] == 0 and rows["1"]["precision"] == 0.5 and rows["0"]["support"] == 2
    assert rows["accuracy"]["f1"] == 0.75
    named = {r["label"] for r in E.class_report(df, "t", "p", ["Low", "Medium", "High"]).collect()}
    assert {"Low", "Medium", "High", "macro avg"} <= named


def test_confusion_matrix_is_dense(spark):
    wide = E.confusion_matrix(frame(spark, [0, 1, 1], [0, 0, 1]), "t", "p", [0, 1])
    assert [tuple(r) for r in wide.collect()] == [(0, 1, 0), (1, 1, 1)]


def test_regressor_metrics(spark):
    y, p = np.array([12.0, 13, 14, 11]), np.array([12.1, 12.9, 14.2, 10.8])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    row = E.evaluate_regressor(df, "y", "p").first().asDict()
    e = y - p
    big = np.expm1(y) - np.expm1(p)
    assert row["r2"] == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["rmse"] == pytest.approx(math.sqrt((e**2).mean()))
    assert row["mae_usd"] == pytest.approx(np.abs(big).mean())
    assert row["mape"] == pytest.approx((np.abs(big) / np.expm1(y)).mean())
    assert set(E.evaluate_regressor(df, "y", "p", log_target=False).columns) == {"r2", "rmse", "mae"}


def test_r2_of_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert E.log_space_r2(df, "y", "p").first()["r2_log_space"] is None
    assert E.evaluate_regressor(df, "y", "p", False).first()["r2"] == 0
    assert E.evaluate_regressor(df.withColumn("p", F.col("y")), "y", "p", False).first()["r2"] == 1


def test_fairness(spark):
    groups = ["a"] * 5 + ["b"] * 5 + ["tiny"] * 4 + [None] * 6
    df = frame(spark, [0, 1] * 10, [0, 1] * 5 + [0, 0] * 5, groups)
    got = {r["group"]: r["score"] for r in E.evaluate_by_group(df, "t", "p", "g").collect()}
    assert got == {"a": 1.0, "b": 1.0}
    assert E.evaluate_by_group(df, "t", "p", "g", metric="accuracy").first()["score"] == 1.0


def test_class_weights(spark):
    got = {r["label"]: r["weight"] for r in E.class_weights(frame(spark, [0, 0, 0, 1], [0] * 4), "t").collect()}
    assert got == {0: pytest.approx(4 / 6), 1: 2.0}


def test_focal_loss(spark):
    df = spark.createDataFrame([(0, [0.9, 0.1]), (1, [0.9, 0.1]), (1, [1.0, 0.0])], "y int, p array<double>")
    got = df.agg(E.focal_loss("y", "p", alpha=[1.0, 3.0])).first()[0]
    want = (0.01 * -math.log(0.9) + 3 * 0.81 * -math.log(0.1) + 3 * (1 - 1e-15) ** 2 * -math.log(1e-15)) / 3
    assert got == pytest.approx(want)


def test_best_model_first_wins_ties(spark):
    rows = [("a", 0.5, 0), ("b", 0.7, 1), ("c", 0.7, 2)]
    df = spark.createDataFrame(rows, "model string, f double, position int")
    assert E.best_model(df, "f").first()["model"] == "b"


def greedy(proba, truth, resolution=50):
    def score(cuts):
        pred = np.argmax(proba / np.maximum(cuts, 1e-6), axis=1)
        f1 = []
        for c in np.union1d(truth, pred):
            hits, s, q = ((pred == c) & (truth == c)).sum(), (truth == c).sum(), (pred == c).sum()
            f1.append(2 * hits / (s + q))
        return np.mean(f1)

    cuts = np.full(proba.shape[1], 0.5)
    best = score(cuts)
    for c in range(len(cuts)):
        chosen = cuts[c]
        for t in np.linspace(0.1, 0.9, resolution):
            trial = cuts.copy()
            trial[c] = t
            if score(trial) > best + 1e-12:
                best, chosen = score(trial), t
        cuts[c] = chosen
    return cuts, best


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_thresholds_equal_exhaustive_search(spark, seed):
    rng = np.random.default_rng(seed)
    truth = rng.integers(0, 4, 300)
    proba = rng.dirichlet(np.ones(4), 300) * 0.7 + 0.3 * np.eye(4)[truth]
    proba = np.round(proba, 2) if seed == 2 else proba
    df = spark.createDataFrame([(int(t), [float(x) for x in p]) for t, p in zip(truth, proba)], "t int, p array<double>")
    rows = H.optimize_thresholds(df, "p", "t", ["Low", "Medium", "High", "Very High"]).orderBy("position").collect()
    cuts, best = greedy(proba, truth)
    assert [r["threshold"] for r in rows] == [round(float(c), 3) for c in cuts]
    assert rows[-1]["macro_f1"] == pytest.approx(best)
    assert all(0.1 <= r["threshold"] <= 0.9 for r in rows)


@pytest.mark.parametrize("resolution", [2, 7, 50, 64])
def test_sweep_equals_direct_counts(spark, resolution):
    rng = np.random.default_rng(5)
    proba, truth = np.round(rng.dirichlet(np.ones(3), 120), 1), rng.integers(0, 3, 120)
    df = spark.createDataFrame([(int(t), [float(x) for x in p]) for t, p in zip(truth, proba)], "t int, p array<double>")
    grid = H.candidate_thresholds(resolution)
    got = {}
    for r in H.sweep_class(df, "p", "t", [0.5, 0.4, 0.3], 1, grid).collect():
        got[r["candidate"], r["y_true"], r["y_pred"]] = r["n"]
    want = {}
    for k, cut in enumerate(grid):
        pred = np.argmax(proba / np.array([0.5, cut, 0.3]), axis=1)
        for t, p in zip(truth, pred):
            want[k, int(t), int(p)] = want.get((k, int(t), int(p)), 0) + 1
    assert got == want
    assert df.select(F.count("*")).first()[0] == 120
