import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from acreage.operators import cleaning as C, monitoring as M
from acreage.plans.listings import clean_listings
from tests.conftest import LISTING_SCHEMA


def test_deduplicate_keeps_the_first_of_exact_and_near_copies(spark, listings):
    near = listings.filter("listing_id = 1").withColumns({
        "listing_id": F.lit(9).cast("long"), "LATITUDE": F.col("LATITUDE") + 0.00001})
    both = listings.unionByName(near).unionByName(listings.filter("listing_id = 2"))
    kept = C.deduplicate(both, ["listing_id"])
    assert sorted(r[0] for r in kept.select("listing_id").collect()) == [1, 2, 3, 4, 5]


def test_deduplicate_treats_nulls_as_equal(spark):
    rows = [(i, None, 1.0, 1.0, 1.0, 40.5, -74.0, "b", "t", "s", "z", "r") for i in (3, 1, 2)]
    assert [r["listing_id"] for r in C.deduplicate(spark.createDataFrame(rows, LISTING_SCHEMA), ["listing_id"]).collect()] == [1]


def test_deduplicate_limits_groups_before_the_shuffle(listings):
    plan = C.deduplicate(listings, ["listing_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Exchange") == 1


def impute_like_pandas(df):
    for c in ("BEDS", "BATH"):
        df[c] = df[c].fillna(df.groupby("BOROUGH")[c].transform("median"))
        df[c] = df[c].fillna(df[c].median())
    df["PROPERTYSQFT"] = df["PROPERTYSQFT"].fillna(df["PROPERTYSQFT"].median())
    return df


def test_impute_uses_group_then_filled_column(spark):
    rng = np.random.default_rng(3)
    rows = [(
        i, 1.0, None if rng.random() < 0.3 else float(rng.integers(1, 7)),
        None if rng.random() < 0.3 else float(rng.integers(1, 5)) / 2,
        None if rng.random() < 0.2 else float(rng.integers(300, 4000)), 40.5, -74.0,
        [None, "a", "b", "empty"][int(rng.integers(4))], "t", "s", "z", "r") for i in range(200)]
    rows = [(*r[:2], None if r[7] == "empty" else r[2], *r[3:]) for r in rows]
    df = spark.createDataFrame(rows, LISTING_SCHEMA)
    got = C.impute_missing(df).orderBy("listing_id").toPandas()
    want = impute_like_pandas(df.orderBy("listing_id").toPandas())
    for c in ("BEDS", "BATH", "PROPERTYSQFT"):
        np.testing.assert_allclose(got[c].to_numpy(), want[c].to_numpy(dtype=float), rtol=0, atol=0)


def test_cap_outliers_at_the_fence(spark):
    df = spark.createDataFrame([(v,) for v in (100.0, 200.0, 300.0, 400.0, 1e8, None)], "PRICE double")
    assert C.cap_outliers(df).agg(F.max("PRICE")).first()[0] == 1000.0
    assert C.cap_outliers(df).filter("PRICE IS NULL").count() == 1


def test_cap_outliers_approximate_mode(spark):
    df = spark.range(1, 1001).selectExpr("CAST(id AS DOUBLE) AS PRICE")
    assert C.cap_outliers(df, ["PRICE"], factor=0.0, exact=False).agg(F.max("PRICE")).first()[0] < 760


def test_filters_drop_nulls(spark, listings):
    broken = listings.withColumn("LATITUDE", F.when(F.col("listing_id") == 1, F.lit(None)).otherwise(F.col("LATITUDE")))
    broken = broken.withColumn("PRICE", F.when(F.col("listing_id") == 2, F.lit(0.0)).otherwise(F.col("PRICE")))
    kept = C.inside_city(C.positive_price_and_size(broken))
    assert sorted(r[0] for r in kept.select("listing_id").collect()) == [3, 4, 5]


def test_clean_listings_leaves_no_issue(make_listings):
    cleaned = clean_listings(make_listings(200), ["listing_id"])
    assert cleaned.count() > 50
    assert M.validation_issues(cleaned).count() == 0


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("a",)], "FOO string")
    assert C.normalize_borough(C.normalize_type(C.normalize_zipcode(df))).collect()[0]["FOO"] == "a"
    assert C.impute_missing(df).count() == 1


def test_distinct_rows(listings):
    assert C.distinct_rows(listings.unionByName(listings)).count() == 5


def test_impute_without_group(spark):
    df = spark.createDataFrame([(1.0,), (None,), (5.0,)], "BEDS double")
    assert sorted(r[0] for r in C.impute_missing(df).collect()) == [1.0, 3.0, 5.0]
    assert pd.isna(C.impute_missing(df.filter("BEDS IS NULL")).first()[0])
