import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.operators import spatial


def brute(points, stations):
    p, s = np.radians(points), np.radians(stations)
    return np.sqrt(((p[:, None, :] - s[None, :, :]) ** 2).sum(-1)).min(1) * 6371


def places(kind, rng):
    if kind == "spread":
        return rng.uniform([40.4, -74.3], [40.95, -73.6], (60, 2))
    if kind == "crowded":
        # one spot holds most stations, the rest are far away
        near = rng.normal([40.75, -73.98], 0.0005, (300, 2))
        return np.vstack([near, rng.uniform([40.4, -74.3], [40.95, -73.6], (20, 2))])
    if kind == "line":
        return np.column_stack([np.full(40, 40.7), np.linspace(-74.2, -73.7, 40)])
    return np.array([[40.7, -74.0]])


@pytest.mark.parametrize("kind", ["spread", "crowded", "line", "single"])
@pytest.mark.parametrize("list_rows", [256, 20])
def test_equals_brute_force(spark, monkeypatch, kind, list_rows):
    monkeypatch.setattr(spatial, "_LIST_ROWS", list_rows)
    rng = np.random.default_rng(7)
    stations = places(kind, rng)
    points = np.vstack([
        rng.uniform([40.3, -74.5], [41.1, -73.4], (150, 2)), rng.normal([40.75, -73.98], 0.001, (150, 2)), stations[:3]])
    df = spark.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "i int, LATITUDE double, LONGITUDE double")
    there = spark.createDataFrame([(float(a), float(b)) for a, b in stations], "latitude double, longitude double")
    got = spatial.nearest_station_distance(df, there).orderBy("i").toPandas()["DIST_NEAREST_SUBWAY"].to_numpy()
    np.testing.assert_allclose(got, brute(points, stations), rtol=1e-9, atol=1e-9)


def test_missing_positions_and_no_stations(spark):
    df = spark.createDataFrame([(1, 40.5, -74.0), (2, None, -74.0)], "i int, LATITUDE double, LONGITUDE double")
    one = spark.createDataFrame([(40.5, -74.0), (None, 1.0)], "latitude double, longitude double")
    got = {r["i"]: r["DIST_NEAREST_SUBWAY"] for r in spatial.nearest_station_distance(df, one).collect()}
    assert got == {1: 0.0, 2: None}
    none = spatial.nearest_station_distance(df, one.filter(F.lit(False)))
    assert none.filter("DIST_NEAREST_SUBWAY IS NULL").count() == 2
