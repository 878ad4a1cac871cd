import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from acreage.constants import ALL_FEATURES
from acreage.ml import training as T
from acreage.ml.clusters import add_neighborhood_clusters, fit_clusters
from acreage.ml.encoders import FrequentCategories, PopulationScaler, SmoothedTargetEncoder, input_features
from acreage.ml.resample import edit, neighbours, oversample, oversample_and_edit
from acreage.ml.search import Whole
from acreage.operators import metrics as E
from acreage.operators.encoding import ordered_target_statistics
from acreage.plans import training as PT
from acreage.session import job, release, stage


@pytest.fixture
def parts(make_listings):
    rows = T.add_class_weights(PT.training_table(make_listings(500), "LISTING_ID", clusters=None))
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


def majority(test):
    counts = [r["n"] for r in test.groupBy(T.LABEL).agg(F.count("*").alias("n")).collect()]
    return max(counts) / sum(counts)


SHORT = {**T.BOOSTER_SPACE, "rounds": Whole(2, 2), "depth": Whole(3, 4)}


def test_classifiers_beat_the_majority_and_survive_saving(spark, parts, tmp_path):
    train, test = parts
    trained = T.train_classifiers(train, test, {
        "forest": T.zone_pipeline(T.zone_forest(15, 6)),
        "booster": T.zone_pipeline(T.zone_booster(6, 3, weight=T.WEIGHT)),
    })
    rows = trained.metrics.collect()
    assert [r["model"] for r in rows] == ["forest", "booster"]
    assert max(r["accuracy"] for r in rows) > majority(test)
    assert trained.extra["fairness"].filter("score NOT BETWEEN 0 AND 1").count() == 0
    for name, model in trained.models.items():
        T.save_model(model, str(tmp_path / name))
        again = T.load_model(str(tmp_path / name))
        a, b = (m.transform(test).select("LISTING_ID", "ZONE_PRED", vector_to_array("ZONE_PROB").alias("p"))
                .orderBy("LISTING_ID").collect() for m in (model, again))
        assert a == b
        assert all(abs(sum(r["p"]) - 1) < 1e-9 and np.argmax(r["p"]) == r["ZONE_PRED"] for r in a)
        assert sorted(input_features(again)) == sorted(ALL_FEATURES)


def test_unseen_categories_are_scored(parts):
    train, test = parts
    model = T.zone_pipeline(T.zone_forest(5, 4)).fit(train)
    odd = test.withColumns({"BOROUGH": F.lit("atlantis"), "ZIPCODE": F.lit("99999")})
    assert model.transform(odd).count() == test.count()


def test_regressors(parts):
    train, test = parts
    trained = T.train_regressors(train, test, {
        "forest": T.price_pipeline(T.price_forest(10, 6)), "line": T.price_pipeline(T.price_line())})
    assert trained.metrics.agg(F.max("r2")).first()[0] > 0.5


def test_network_and_fallback_onehot(parts):
    train, test = parts
    trained = T.train_classifiers(train, test, {
        "network": T.network_pipeline(train, (16,), 40, fallback_onehot=True)}, group=None)
    assert trained.metrics.first()["accuracy"] > 0.3


def test_tuning_keeps_the_best_trial(parts):
    train, _ = parts
    model, chosen, trials = T.tune_classifier(train, "LISTING_ID", trials=2, folds=2, space=SHORT)
    rows = trials.collect()
    best = max(rows, key=lambda r: r["mean_score"])
    assert str(chosen) == best["parameters"] and 3 <= chosen["depth"] <= 4
    assert model.stages[-1].getOrDefault("rounds") == 2
    model, chosen, trials = T.tune_regressor(train, "LISTING_ID", trials=2, folds=2, space=SHORT)
    assert trials.count() == 2 and len(model.stages[-1].trees) == 2


def test_stacking(spark, parts, tmp_path):
    train, test = parts
    stacked = T.fit_stacking(train, "LISTING_ID", {
        "a": T.zone_pipeline(T.zone_forest(8, 5)), "b": T.zone_pipeline(T.zone_booster(3, 3))}, folds=2)
    row = E.evaluate_classifier(stacked.transform(test), T.LABEL, "ZONE_PRED").first()
    assert row["accuracy"] > majority(test)
    T.save_model(stacked, str(tmp_path / "stacked"), [0.4, 0.5, 0.6, 0.5])
    again = T.load_model(str(tmp_path / "stacked"))
    a, b = (m.transform(test).select("LISTING_ID", "ZONE_PRED").orderBy("LISTING_ID").collect() for m in (stacked, again))
    assert a == b and T.load_thresholds(str(tmp_path / "stacked")) == [0.4, 0.5, 0.6, 0.5]


def test_forests_with_equal_preprocessing_share_its_fit(spark, parts, monkeypatch):
    train = stage(parts[0].coalesce(1), "train")
    fits, plain = [], SmoothedTargetEncoder._fit
    monkeypatch.setattr(SmoothedTargetEncoder, "_fit", lambda self, df: fits.append(self.getLabelCol()) or plain(self, df))
    pipelines = {"few": T.zone_pipeline(T.zone_forest(3, 2)), "line": T.price_pipeline(T.price_line()),
                 "more": T.zone_pipeline(T.zone_forest(4, 3, weight=None))}
    models = T.fit_all(pipelines, train)
    assert list(models) == list(pipelines) and sorted(fits) == [T.TARGET, T.LABEL]
    for name, output in (("few", "ZONE_PROB"), ("more", "ZONE_PROB"), ("line", "PRICE_PRED")):
        want = pipelines[name].fit(train).transform(parts[1]).select("LISTING_ID", output).toPandas().sort_values("LISTING_ID")
        got = models[name].transform(parts[1]).select("LISTING_ID", output).toPandas().sort_values("LISTING_ID")
        assert np.allclose([np.ravel(x) for x in got[output]], [np.ravel(x) for x in want[output]], rtol=0, atol=1e-9)
    fits.clear()
    T.fit_stacking(train, "LISTING_ID", {n: pipelines[n] for n in ("few", "more")}, folds=2)
    assert len(fits) == 3  # once per fold and once on all rows


def test_attempt_inference(spark, parts, tmp_path):
    train, test = parts
    path = str(tmp_path / "model")
    assert T.attempt_inference(test, path)[1]["status"] == "skipped"
    T.save_model(T.price_pipeline(T.price_line()).fit(train), path)
    predictions, record = T.attempt_inference(test, path)
    assert record["status"] == "succeeded" and predictions.filter("PRICE_PRED IS NULL").count() == 0
    _, record = T.attempt_inference(test.drop("BEDS"), path)
    assert (record["status"], record["stage"], record["missing_features"]) == ("failed", "predict", ["BEDS"])
    (tmp_path / "broken" / "metadata").mkdir(parents=True)
    assert T.attempt_inference(test, str(tmp_path / "broken"))[1]["stage"] == "load"


def test_encoder_stages(spark):
    df = spark.createDataFrame([(1.0, "a", 1.0), (2.0, "b", 0.0), (3.0, "a", 1.0)], "x double, c string, y double")
    z = PopulationScaler(inputCols=["x"], outputCols=["z"]).fit(df).transform(df)
    assert z.agg(F.stddev_pop("z")).first()[0] == pytest.approx(1)
    top = FrequentCategories(inputCols=["c"], outputCols=["t"], limit=1).fit(df).transform(df)
    assert sorted(r["t"] for r in top.collect()) == ["a", "a", "other"]
    model = SmoothedTargetEncoder(inputCols=["c"], outputCols=["e"], labelCol="y").fit(df.filter("c = 'a'"))
    assert {r["c"]: r["e"] for r in model.transform(df).collect()} == {"a": 1.0, "b": 1.0}


def test_ordered_statistics_leave_the_own_target_out(spark):
    rows = [(i, "hot" if i % 3 else f"c{i % 5}", float(i % 7) if i % 11 else None) for i in range(400)] + [(900, None, 3.0), (901, "once", 5.0)]
    df = spark.createDataFrame(rows, "k long, c string, y double")
    got = {r.k: r.c_OTS for r in ordered_target_statistics(df, "k", ["c"], "y", strength=2.0).collect()}
    counted = [y for *_, y in rows if y is not None]
    prior = sum(counted) / len(counted)
    order = sorted(rows, key=lambda r: (hashlib.md5(f"42:{r[0]}".encode()).hexdigest(), r[0]))
    seen = {}
    for k, c, y in order:
        n, total = seen.get(c, (0, 0.0)) if c else (0, 0.0)
        assert got[k] == pytest.approx((total + 2 * prior) / (n + 2))
        if y is not None:
            seen[c] = (n + 1, total + y)
    assert got[900] == pytest.approx(prior) and got[901] == pytest.approx(prior) and len(got) == len(rows)
    assert ordered_target_statistics(df.limit(0), "k", ["c"], "y").count() == 0


def test_ordered_pipeline_learns_from_rows_before(parts):
    train, test = parts
    model = T.ordered_zone_pipeline(T.zone_booster(3, 3), "LISTING_ID").fit(train)
    assert sorted(input_features(model)) == sorted(ALL_FEATURES)
    scored = model.transform(test)
    assert E.evaluate_classifier(scored, T.LABEL, "ZONE_PRED").first()["accuracy"] > majority(test) and scored.count() == test.count()


def test_a_fitted_encoder_outlives_the_job(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("a", 1.0)], "c string, y double")
    with job(spark):
        kept = stage(df, "beside")
        with job(spark):
            model = SmoothedTargetEncoder(inputCols=["c"], outputCols=["e"], labelCol="y").fit(df)
        assert kept.count() == 3
    release(spark)
    assert model.transform(df).count() == 3
    model.write().overwrite().save(str(tmp_path / "encoder"))


def test_clusters(make_listings):
    df = make_listings(100)
    out = add_neighborhood_clusters(df, 5, starts=2)
    assert out.count() == 100 and out.filter("NEIGHBORHOOD_CLUSTER NOT BETWEEN 0 AND 4").count() == 0
    one = fit_clusters(df, 5, starts=1).cost
    assert fit_clusters(df, 5, starts=4).cost <= one


def test_ten_starts_in_one_pass_a_step(spark, make_listings, monkeypatch):
    df = make_listings(900)
    spots = df.unionByName(df.filter("listing_id % 3 = 0")).unionByName(df.limit(2).withColumn("LATITUDE", F.lit(None).cast("double")))
    got = fit_clusters(spots, 6)
    x = np.array([[r.LATITUDE, r.LONGITUDE] for r in spots.dropna(subset=["LATITUDE"]).collect()])
    far = ((x[:, None] - got.centres[None]) ** 2).sum(-1)
    assert far.min(axis=1).sum() == pytest.approx(got.cost, abs=1e-5)
    kept = got.transform(spots).collect()
    assert len(kept) == len(x)
    assert all(r.NEIGHBORHOOD_CLUSTER == ((got.centres - [r.LATITUDE, r.LONGITUDE]) ** 2).sum(1).argmin() for r in kept)
    points = VectorAssembler(inputCols=["LATITUDE", "LONGITUDE"], outputCol="p", handleInvalid="skip").transform(spots)
    separate = min(KMeans(k=6, seed=s, featuresCol="p").fit(points).summary.trainingCost for s in range(10))
    assert got.cost <= separate * 1.0001
    assert (fit_clusters(spots.repartition(7), 6).centres == got.centres).all()
    monkeypatch.setattr("acreage.ml.clusters.SAMPLE", 50)  # starts from a sample move on over all points
    assert fit_clusters(spots, 6).cost <= separate * 1.01
    with pytest.raises(ValueError):
        fit_clusters(df.limit(0), 3)
    assert fit_clusters(df.limit(2), 5, starts=2).cost == pytest.approx(0)


def cloud(spark, sizes=(60, 15, 5), seed=0):
    rng = np.random.default_rng(seed)
    rows, key = [], 0
    for label, n in enumerate(sizes):
        for _ in range(n):
            x = rng.normal(label * 6, 1, 2)
            rows.append((key, float(x[0]), float(x[1]), label))
            key += 1
    return spark.createDataFrame(rows, "k long, a double, b double, y int")


def test_neighbours_equal_brute_force_when_the_reach_covers_all(spark):
    df = cloud(spark).withColumn("v", F.array("a", "b"))
    got = neighbours(df, "k", "v", 3, 2, reach=100, projections=1).toPandas()
    pdf = df.toPandas()
    x = pdf[["a", "b"]].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for k, part in got.groupby("key"):
        assert set(part["other"]) == set(np.argsort(d[k])[:3])
    assert got.groupby("key").size().eq(3).all()


@pytest.mark.parametrize("reach", [3, 40])
def test_neighbours_do_not_depend_on_partitions(spark, reach):
    df = cloud(spark, (300, 80, 20)).withColumn("v", F.array("a", "b"))
    found = []
    for tasks in (1, 4, 16, 64):
        settings = {"spark.sql.shuffle.partitions": tasks, "spark.sql.adaptive.enabled": "false"}
        before = {k: spark.conf.get(k) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = neighbours(df.repartition(tasks), "k", "v", 3, 2, "y", projections=2, reach=reach, block=37)
        found.append(sorted((r["key"], r["other"]) for r in got.collect()))
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found[0] and all(f == found[0] for f in found)


def test_neighbours_stay_linear_with_copies(spark):
    same = spark.range(3000).selectExpr("id AS k", "array(1D, 1D) AS v", "'x' AS g")
    got = neighbours(same, "k", "v", 2, 2, "g", projections=2, reach=4)
    per_row = got.groupBy("key").count()
    assert per_row.count() == 3000 and per_row.agg(F.max("count")).first()[0] == 2


def test_oversampling_balances_inside_the_class(spark):
    df = cloud(spark)
    out = oversample(df, "k", ["a", "b"], "y")
    assert {r["y"]: r["n"] for r in out.groupBy("y").agg(F.count("*").alias("n")).collect()} == {0: 60, 1: 60, 2: 60}
    made, real = out.filter("synthetic").toPandas(), df.toPandas()
    assert made["k"].is_unique and (made["k"] < 0).all()
    for y in (1, 2):
        inside, source = made[made["y"] == y], real[real["y"] == y]
        for c in ("a", "b"):
            assert inside[c].between(source[c].min(), source[c].max()).all()


def test_editing_removes_rows_their_neighbours_deny(spark):
    lost = spark.createDataFrame([(1000, 0.0, 0.0, 2)], "k long, a double, b double, y int")
    kept = edit(cloud(spark).unionByName(lost), "k", ["a", "b"], "y", cell=7)
    assert kept.filter("k = 1000").count() == 0
    assert kept.filter("y = 1").count() > 10


def test_oversample_and_edit_runs_on_balanced_input(spark):
    df = cloud(spark, (10, 10))
    assert oversample_and_edit(df, "k", ["a", "b"], "y").count() <= 20
    assert isinstance(oversample(df, "k", ["a", "b"], "y").toPandas(), pd.DataFrame)
