import math

import pytest
from pyspark.sql import functions as F

from acreage.constants import ALL_FEATURES
from acreage.operators import encoding, explain, features as P, guards as G, scoring as S
from acreage.plans import listings as L
from acreage.schemas import REQUESTS


def test_numeric_features(listings):
    row = P.add_numeric_features(listings).filter("listing_id = 3").first()
    assert row["TOTAL_ROOMS"] == 7 and row["BED_BATH_RATIO"] == pytest.approx(5 / 2)
    assert row["LOG_SQFT"] == pytest.approx(math.log1p(2750)) and row["ROOMS_PER_SQFT"] == pytest.approx(7 / 2750)


def test_clipping_keeps_null_and_small_values(spark):
    df = spark.createDataFrame([(2.0, 0.0, 0.0), (2.0, None, None)], "BEDS double, BATH double, PROPERTYSQFT double")
    rows = P.add_numeric_features(df).collect()
    assert rows[0]["BED_BATH_RATIO"] == 2 and rows[0]["ROOMS_PER_SQFT"] == 2
    assert rows[1]["BED_BATH_RATIO"] is None and rows[1]["ROOMS_PER_SQFT"] is None


def test_targets(listings):
    rows = {r["listing_id"]: r for r in P.add_zone_code(P.add_target_variables(listings)).collect()}
    assert [rows[i]["PRICE_ZONE"] for i in range(1, 6)] == ["Low", "Medium", "High", "Low", "Very High"]
    assert rows[5]["ZONE_CODE"] == 3 and rows[5]["SQFT_CATEGORY"] == "Large"


def test_cardinality_cap(spark):
    df = spark.createDataFrame([(f"v{i:03d}",) for i in range(100)] + [("v050",), (None,)], "TYPE string")
    out = P.cap_categorical_cardinality(df, ["TYPE", "ABSENT"], 10)
    values = {r[0]: r[1] for r in out.groupBy("TYPE").count().collect()}
    assert len(values) == 11 and values["v050"] == 2 and "v000" in values and "v009" not in values
    assert values["other"] == 91


def test_cardinality_cap_of_numbers(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "ZIPCODE int")
    out = P.cap_categorical_cardinality(df, ["ZIPCODE"], 1)
    assert sorted(r[0] for r in out.collect()) == ["1", "1", "other"]


def test_default_columns(spark):
    df = spark.createDataFrame([("soho",)], "SUBLOCALITY string")
    row = P.add_default_columns(df).first()
    assert (row["BOROUGH"], row["PROPERTY_CATEGORY"]) == ("soho", "residential")
    row = P.add_default_columns(spark.createDataFrame([(1,)], "X int")).first()
    assert (row["BOROUGH"], row["SUBLOCALITY"]) == ("unknown", "unknown")


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "` price ` int, Beds int")
    assert P.normalize_names(df).columns == ["PRICE", "BEDS"]
    assert P.normalize_names(df, upper=False).columns == ["price", "Beds"]


def test_feature_pipeline(make_listings, spark):
    stations = spark.createDataFrame([(40.75, -73.98), (40.7, -73.9)], "latitude double, longitude double")
    out = L.feature_pipeline(make_listings(120), stations, clusters=4, keys=["listing_id"])
    assert {"HEX_CELL", "NEIGHBORHOOD_CLUSTER", "PRICE_ZONE", "DIST_CENTRAL_PARK"} <= set(out.columns)
    assert out.filter("NEIGHBORHOOD_CLUSTER NOT BETWEEN 0 AND 3").count() == 0
    with pytest.raises(G.LeakageError):
        L.feature_pipeline(make_listings(20).withColumn("PRICE_PER_SQFT", F.lit(1.0)), clusters=None)


def test_training_data_has_all_features(make_listings):
    out = L.prepare_training_data(make_listings(60).drop("PROPERTY_CATEGORY"), clusters=None)
    assert P.model_features(out).columns == ALL_FEATURES
    assert "HEX_CELL" not in out.columns


REQUEST = (1, None, 2, 2.0, 1200.0, "Manhattan", "Condo", "10022", 40.758, -73.985, None)


@pytest.mark.parametrize("field,value,bad", [
    (None, None, []), ("zipcode", "abc", ["zipcode"]), ("zipcode", "100222", ["zipcode"]), ("zipcode", "10022\n", ["zipcode"]),
    ("propertysqft", -100.0, ["propertysqft"]), ("propertysqft", 0.0, ["propertysqft"]), ("propertysqft", 50000.0, []),
    ("beds", 21, ["beds"]), ("beds", 0, []), ("bath", 15.5, ["bath"]), ("latitude", 41.0, ["latitude"]),
    ("longitude", -75.0, ["longitude"]), ("borough", None, ["borough"]), ("beds", None, ["beds"])])
def test_request_validation(spark, field, value, bad):
    row = list(REQUEST)
    if field:
        row[REQUESTS.fieldNames().index(field)] = value
    checked = S.validate_requests(spark.createDataFrame([tuple(row)], REQUESTS)).first()
    assert checked["rejected"] == bad and checked["sublocality"] == "unknown"


def test_request_features_equal_training_features(spark, listings):
    request = listings.selectExpr(
        "listing_id AS request_id", "CAST(BEDS AS INT) AS beds", "BATH AS bath", "PROPERTYSQFT AS propertysqft",
        "upper(BOROUGH) AS borough", "TYPE AS type", "ZIPCODE AS zipcode", "LATITUDE AS latitude",
        "LONGITUDE AS longitude", "SUBLOCALITY AS sublocality")
    served = S.request_features(request, ["request_id"]).orderBy("request_id").select(*ALL_FEATURES).collect()
    trained = P.add_subway_proxy(P.add_distance_features(P.add_numeric_features(listings)))
    assert served == trained.orderBy("listing_id").select(*ALL_FEATURES).collect()


def test_records(spark):
    df = spark.createDataFrame([([0.1, 0.2, 0.6, 0.1], math.log1p(123456.0))], "p array<double>, y double")
    row = df.select(S.zone_record(F.col("p")).alias("z"), S.price_record(F.col("y")).alias("r"),
                    S.zone_record(F.col("p"), thresholds=[0.1, 0.9, 0.9, 0.9]).alias("t")).first()
    assert row["z"]["price_zone"] == "High" and row["z"]["confidence"] == 0.6
    assert row["z"]["probabilities"]["Very High"] == 0.1
    assert row["r"]["predicted_price"] == 123500
    assert row["r"]["price_range"]["low"] < 123500 < row["r"]["price_range"]["high"]
    assert row["t"]["price_zone"] == "Low" and row["t"]["confidence"] == 0.6


def test_target_encodings(spark):
    rows = [("a", 1.0)] * 30 + [("b", 0.0)] * 10 + [(None, 1.0)]
    df = spark.createDataFrame(rows, "c string, y double")
    table, prior = encoding.target_encodings(df, ["c"], "y")
    got = {r["category"]: r["encoded"] for r in table.collect()}
    w = 1 / (1 + math.exp(-1))
    assert prior == pytest.approx(31 / 41) and got["a"] == pytest.approx(w + (1 - w) * prior)
    assert got["b"] == pytest.approx((1 - 1 / (1 + math.exp(1))) * prior)
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    out = [r["c_TE"] for r in encoding.apply_target_encodings(new, table, prior, ["c"]).collect()]
    assert sorted(out) == pytest.approx(sorted([got["a"], prior, prior]))
    shrunk = {r["category"]: r["encoded"] for r in encoding.target_encodings(df, ["c"], "y", "m_estimate")[0].collect()}
    assert shrunk["a"] == pytest.approx(0.75 + 0.25 * prior)


def test_standardize_and_label_codes(spark):
    df = spark.createDataFrame([(1.0, 5.0, "b"), (3.0, 5.0, "a")], "x double, flat double, s string")
    out = encoding.standardize(df, ["x", "flat"]).orderBy("x").collect()
    assert [r["z_x"] for r in out] == [-1, 1] and [r["z_flat"] for r in out] == [0, 0]
    assert [tuple(r) for r in encoding.label_codes(df, "s").collect()] == [(0, "a"), (1, "b")]


def test_top_factors_and_importance(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5), (1, "b", -0.7), (1, "c", 0.0), (2, "a", -0.1)], "row_id long, feature string, value double")
    rows = [tuple(r)[2:] for r in explain.top_factors(df, 2).orderBy("row_id", "rank").collect()]
    assert rows == [("b", -0.7, "-"), ("a", 0.5, "+"), ("a", -0.1, "-")]
    assert [r["feature"] for r in explain.global_importance(df).collect()] == ["b", "a", "c"]


def test_shapley_of_a_linear_score_is_exact(spark):
    rows = [(i, float(i % 7), float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    got = explain.shapley_values(
        df, "k", ["a", "b"], lambda d: d.withColumn("score", 2 * F.col("a") - F.col("b") + 1),
        max_samples=10, background=1, permutations=3)
    rows = got.toPandas().pivot(index="row_id", columns="feature", values="value")
    assert len(rows) == 10
    values = {r[0]: r for r in df.collect()}
    base = {(round(values[k][1] * 2 - v["a"], 9), round(-values[k][2] - v["b"], 9)) for k, v in rows.iterrows()}
    # with one background row the attribution is 2 * (a - a0) and -(b - b0), whatever the order
    assert len(base) == 1


def test_linear_attributions(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "k long, a double")
    got = {r["row_id"]: r["value"] for r in explain.linear_attributions(df, "k", {"a": 2.0}).collect()}
    assert got == {1: -2.0, 2: 2.0}
