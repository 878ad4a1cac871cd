import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acreage.operators import ranking
from acreage.operators.guards import same_rows
from acreage.operators.joins import lookup_join
from acreage.operators.quantiles import exact_quantiles, group_medians
from acreage.operators.ranking import assign_folds, digest_rank, sample_rows, stratified_split, value_ranks

SHAPES = {
    "uniform": lambda rng, n: rng.uniform(-5, 5, n),
    "heavy_tail": lambda rng, n: rng.pareto(0.5, n),
    "one_hot_value": lambda rng, n: np.where(rng.random(n) < 0.4, 7.0, rng.normal(7, 3, n)),
    "few_values": lambda rng, n: rng.integers(0, 3, n).astype(float),
    "constant": lambda rng, n: np.full(n, 2.5),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_search_equals_numpy(spark, shape):
    values = SHAPES[shape](np.random.default_rng(5), 3001)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, ["v"], probs, direct_rows=10, final_rows=20, accuracy=50)["v"]
    np.testing.assert_allclose(found, np.quantile(values, probs), rtol=1e-12)
    assert exact_quantiles(df, ["v"], probs)["v"] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}
    assert exact_quantiles(df, ["a", "b"], [0.5], rows=1) == {"a": [None], "b": [1.0]}


def test_group_medians(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 300, p=[0.8, 0.15, 0.05]), "x": rng.integers(0, 9, 300) / 2})
    got = {r["g"]: r["median"] for r in group_medians(spark.createDataFrame(pdf), "g", ["x"]).collect()}
    assert got == pdf.groupby("g")["x"].median().to_dict()


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_value_ranks(spark, n):
    rng = np.random.default_rng(n)
    frames = []
    for name in ("a", "b"):
        v = np.where(rng.random(n) < 0.3, 1.0, np.round(rng.normal(0, 2, n), 2))
        frames.append(pd.DataFrame({"variable": name, "value": v}))
    pdf = pd.concat(frames)
    got = value_ranks(spark.createDataFrame(pdf), "variable", "value").toPandas()
    pdf["mean_rank"] = pdf.groupby("variable")["value"].rank(method="average")
    pdf["first_rank"] = pdf.groupby("variable")["value"].rank(method="min")
    merged = got.merge(pdf.drop_duplicates(["variable", "value"]), on=["variable", "value"], suffixes=("", "_want"))
    assert len(merged) == len(got)
    assert (merged["mean_rank"] == merged["mean_rank_want"]).all()
    assert (merged["first_rank"] == merged["first_rank_want"]).all()
    assert (got["total"] == n).all()


def test_value_ranks_with_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_RANGE_ROWS", 1)
    values = [float(v) for v in np.random.default_rng(1).normal(size=3000)]
    df = spark.createDataFrame([("a", v) for v in values], "variable string, value double")
    got = value_ranks(df, "variable", "value").toPandas()
    assert (got.sort_values("value")["first_rank"].to_numpy() == np.arange(1, 3001)).all()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_lookups_isolate_hot_keys(spark, how):
    rows = spark.createDataFrame(
        [(i, "hot" if i % 2 else f"k{i % 900}", None if i % 7 == 0 else i % 3) for i in range(4000)],
        "i int, k string, j int")
    lookup = rows.groupBy("k", "j").agg(F.count("*").alias("n")).filter("k <> 'k10'")
    want = rows.join(lookup, ["k", "j"], how)
    got = lookup_join(rows, lookup, ["k", "j"], how, broadcast_bytes=-1)
    assert same_rows(want, got)
    one = rows.groupBy("j").agg(F.count("*").alias("n"))
    assert same_rows(rows.join(one, ["j"], how), lookup_join(rows, one, ["j"], how, broadcast_bytes=-1))


def digest(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), key


def test_stratified_split_is_exact(spark):
    rows = [(i, "big" if i % 10 else "small") for i in range(1003)]
    df = spark.createDataFrame(rows, "k long, s string")
    got = {r["k"]: r["split"] for r in stratified_split(df, "k", "s").collect()}
    for stratum in ("big", "small"):
        keys = sorted((k for k, s in rows if s == stratum), key=digest)
        take = int(0.2 * len(keys) + 0.5)
        assert {k for k in keys if got[k] == "test"} == set(keys[:take])


def test_stratified_split_of_tiny_and_null_strata(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, None)], "k long, s string")
    got = Counter((r["s"], r["split"]) for r in stratified_split(df, "k", "s").collect())
    assert got == {("a", "train"): 1, (None, "train"): 2, (None, "test"): 1}


def test_folds_are_even_within_strata(spark):
    df = spark.range(997).selectExpr("id AS k", "id % 3 AS s")
    got = assign_folds(df, "k", "s").toPandas()
    assert got.groupby("s")["fold"].value_counts().groupby("s").agg(lambda v: v.max() - v.min()).max() <= 1
    ranks = digest_rank(df, "k", "s").toPandas()
    for s, part in ranks.groupby("s"):
        assert list(part.sort_values("rank")["k"]) == sorted(part["k"], key=digest)


def test_sample_rows(spark):
    got = {r[0] for r in sample_rows(spark.range(500).toDF("k"), "k", 20).collect()}
    assert got == set(sorted(range(500), key=digest)[:20])


def test_split_does_not_shuffle_rows(spark, tmp_path):
    spark.range(5000).selectExpr("id AS k", "id % 4 AS s", "repeat('x', 50) AS wide").write.parquet(str(tmp_path / "t"))
    plan = stratified_split(spark.read.parquet(str(tmp_path / "t")), "k", "s")
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text.split("InMemoryRelation")[0]
    assert "BroadcastHashJoin" in final and "Exchange hashpartitioning" not in final
    assert plan.agg(F.count("*")).first()[0] == 5000
