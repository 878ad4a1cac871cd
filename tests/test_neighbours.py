"""Exact neighbours against all pairs, and how much of them the search along directions finds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.ml import neighbours as N
from acreage.ml.neighbours import nearest_rows
from acreage.ml.resample import neighbours

SCHEMA = "k long, v array<double>, g string"


def rows(seed=0, n=260, dimensions=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        centre = rng.choice([-40.0, 0.0, 25.0])
        v = rng.normal(centre, 1 + abs(centre) / 10, dimensions)
        out.append((i * 7 % 1009, [float(x) for x in np.round(v, 1)], ["a", "b", None][i % 3]))
    out += [(2000 + i, [1.0] * dimensions, "a") for i in range(12)]  # copies
    out += [(3000, [5e5] * dimensions, "a"), (3001, [0.0] * dimensions, "lone"), (3002, [-0.0, *[1.0] * (dimensions - 1)], "b"),
            (3003, [0.0, *[1.0] * (dimensions - 1)], "b"), (3004, None, "a"), (3005, [float("nan")] * dimensions, "a"),
            (3006, [None, *[1.0] * (dimensions - 1)], "a")]
    return out


def brute(table, k, grouped=True):
    whole = [(i, np.array(v), g) for i, v, g in table if v is not None and all(x is not None and x == x for x in v)]
    out = []
    for i, v, g in whole:
        others = sorted((float(np.sqrt(sum((v - w) ** 2))), j) for j, w, h in whole if j != i and (h == g or not grouped))
        out += [(i, j, d) for d, j in others[:k]]
    return sorted(out)


def same(got, want):
    got = sorted((r.key, r.other, r.distance) for r in got)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], rtol=1e-12)


@pytest.mark.parametrize("parts,cell,grouped,visitors", [(1, 2000, True, 20_000), (3, 9, True, 20_000), (8, 15, False, 11)])
def test_neighbours_equal_all_pairs(spark, monkeypatch, parts, cell, grouped, visitors):
    monkeypatch.setattr(N, "VISITORS", visitors)
    table = rows()
    df = spark.createDataFrame(table, SCHEMA).withColumns({c: F.lit(0) for c in ("vector", "cell", "point", "other")})
    got = nearest_rows(df.repartition(parts), "k", "v", 4, 3, "g" if grouped else None, cell=cell).collect()
    same(got, brute(table, 4, grouped))


def test_copies_take_no_pairs(spark):
    copies = spark.range(30_000).selectExpr("id AS k", "array(1D, 1D) AS v", "'x' AS g")
    got = nearest_rows(copies, "k", "v", 3, 2, "g")
    assert got.groupBy("key").count().where("count = 3").count() == 30_000
    assert {r.other for r in got.where("key = 29999").collect()} == {0, 1, 2} and {r.other for r in got.where("key = 1").collect()} == {0, 2, 3}


def test_few_rows(spark):
    assert nearest_rows(spark.createDataFrame([], SCHEMA), "k", "v", 3, 2, "g").count() == 0
    two = spark.createDataFrame([(1, [0.0, 0.0], "a"), (2, [3.0, 4.0], "a"), (3, [0.0, 0.0], "b")], SCHEMA)
    assert sorted(map(tuple, nearest_rows(two, "k", "v", 3, 2, "g").collect())) == [(1, 2, 5.0), (2, 1, 5.0)]


def test_recall_of_the_search_along_directions(spark):
    """The former search of the balancing finds most, not all, of the neighbours this join finds."""
    table = [r for r in rows(n=600) if r[0] < 2000]
    df = spark.createDataFrame(table, SCHEMA)
    want = {(i, j) for i, j, _ in brute(table, 5, False)}
    exact = {(r.key, r.other) for r in nearest_rows(df, "k", "v", 5, 3, cell=40).collect()}
    along = {(r.key, r.other) for r in neighbours(df, "k", "v", 5, 3, reach=10).collect()}
    assert exact == want
    recall = len(along & want) / len(want)
    assert 0.5 < recall < 1, recall
    print(f"recall along directions: {recall:.3f}")
