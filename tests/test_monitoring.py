import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.constants import PRICE_ZONES
from acreage.operators import features as P, guards as G, monitoring as M
from acreage.sources import files


@pytest.fixture
def inputs(spark):
    rng = np.random.default_rng(42)
    rows = [(int(rng.integers(1, 6)), float(rng.choice([1, 1.5, 2])), float(rng.uniform(400, 4000)), "manhattan")
            for _ in range(100)]
    return spark.createDataFrame(rows, "BEDS int, BATH double, PROPERTYSQFT double, BOROUGH string")


def test_feature_stats_match_pandas(inputs):
    got = {r["feature"]: r for r in M.feature_stats(inputs).collect()}
    want = inputs.toPandas().describe()
    assert set(got) == {"BEDS", "BATH", "PROPERTYSQFT"}
    for name, r in got.items():
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("count", "count")):
            assert r[ours] == pytest.approx(want[name][theirs])


def test_stats_skip_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    rows = M.feature_stats(df).collect()
    assert [(r["feature"], r["count"], r["std"]) for r in rows] == [("a", 1, None)]


def test_drift(inputs):
    base = M.feature_stats(inputs)
    assert M.detect_drift(inputs, base).count() == 0
    moved = inputs.withColumn("BEDS", F.col("BEDS") + 10)
    row = M.check_drift(moved, base).first()
    assert row["feature"] == "BEDS" and row["shift_ratio"] > 0.15
    with pytest.raises(G.DriftError, match="BEDS"):
        M.check_drift(moved, base, fail_on_drift=True)
    assert M.check_drift(inputs, base, fail_on_drift=True).count() == 0
    assert M.detect_drift(moved.drop("BEDS"), base).count() == 0


def test_drift_of_constant_and_single_baselines(spark):
    flat = spark.createDataFrame([(1.0, 5.0), (1.0, None)], "flat double, single double")
    now = spark.createDataFrame([(1.2, 50.0)], "flat double, single double")
    got = [r["feature"] for r in M.detect_drift(now, M.feature_stats(flat)).collect()]
    assert got == ["flat"]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_baseline_round_trip(spark, inputs, tmp_path, fmt):
    base = M.feature_stats(inputs)
    files.save_baseline(base, str(tmp_path / fmt), fmt)
    again = files.load_baseline(spark, str(tmp_path / fmt), fmt)
    assert G.same_rows(base, again.select(*base.columns))


@pytest.mark.parametrize("column,value,check", [
    ("PRICE", -100.0, "non_positive"), ("PROPERTYSQFT", -50.0, "non_positive"), ("LATITUDE", 50.0, "out_of_range"),
    ("LONGITUDE", -80.0, "out_of_range"), ("PRICE", None, "null"), ("LATITUDE", None, "out_of_range")])
def test_validation_issue(listings, column, value, check):
    bad = F.when(F.col("listing_id") == 1, F.lit(value)).otherwise(F.col(column))
    rows = M.validation_issues(listings.withColumn(column, bad)).collect()
    assert [(r["check"], r["column"], r["n"]) for r in rows] == [(check, column, 1)]


def test_validation_of_clean_and_foreign_tables(spark, listings):
    assert M.validation_issues(listings).count() == 0
    rows = M.validation_issues(spark.createDataFrame([(1,)], "FOO int")).collect()
    assert {r["check"] for r in rows} == {"missing_column"} and len(rows) == 7


HEALTH = {
    "constant": ([500000.0] * 1000, "prediction collapse"),
    "near_constant": ([500000.0] * 960 + [float(i) for i in range(40)], "prediction collapse"),
    "nan": ([float("nan")] * 1000, "nan predictions"),
    "null": ([None] + [float(i) for i in range(999)], "nan predictions"),
    "infinite": ([float("inf")] + [float(i) for i in range(999)], "inf predictions"),
    "few": ([1.0] * 499, "insufficient predictions"),
    "exactly_95_percent": ([1.0] * 950 + [float(i) for i in range(2, 52)], None),
    "healthy": ([float(i) for i in range(1000)], None),
}


@pytest.mark.parametrize("case", HEALTH)
def test_prediction_health(spark, case):
    values, failure = HEALTH[case]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    assert M.prediction_health(df, "p").first()["failure"] == failure
    if failure:
        with pytest.raises(G.HealthError, match=failure.split()[-1]):
            M.check_predictions_healthy(df, "p")
    else:
        M.check_predictions_healthy(df, "p")


def test_health_of_nothing(spark):
    row = M.prediction_health(spark.createDataFrame([], "p double"), "p").first()
    assert (row["n"], row["failure"]) == (0, "insufficient predictions")


def test_profile_and_summary(listings):
    rows = {r["column"]: r for r in M.profile(listings, ["BOROUGH", "PRICE"]).collect()}
    assert rows["BOROUGH"]["distinct_values"] == 5 and rows["BOROUGH"]["nulls"] == 0
    row = M.cleaning_summary(listings, listings.limit(3)).first()
    assert (row["n_raw"], row["n_clean"], row["n_dropped"]) == (5, 3, 2)


def test_zone_share_in_zone_order(listings):
    rows = M.zone_share(P.add_target_variables(listings)).collect()
    assert [r["PRICE_ZONE"] for r in rows] == PRICE_ZONES
    assert sum(r["pct"] for r in rows) == pytest.approx(100)


def test_histogram(spark):
    values = [0.0, 1.0, 2.0, 49.9, 50.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["bin"]: r["n"] for r in M.histogram(df, "v", 50).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 49: 2}
    assert M.histogram(df.filter("v IS NULL"), "v").count() == 0
    assert M.histogram(df.filter("v = 1"), "v").first()["n"] == 1
