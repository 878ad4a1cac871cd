import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.constants import FORBIDDEN_COLUMNS, LEAKY_FEATURES
from acreage.operators import dependence, firewall as W, guards as G

NUMERIC = ["land_sqft", "property_sqft", "year_built", "zip_code"]


def test_golden_counts(sales):
    _, report = W.apply_schema_map(sales, ["sale_id"])
    row = report.first()
    assert (row["n_raw"], row["n_scored"], row["n_dropped"]) == (24, 15, 9)
    assert row["drop_reasons"] == {
        "sale_price_non_positive": 1, "sale_price_out_of_range": 2, "missing_gross_sqft": 1,
        "missing_year_built": 1, "non_residential_class": 4}
    check = G.drop_log_consistent(report).first()
    assert check["consistent"] and check["n_reasons"] == 9


def test_mapped_row(sales):
    mapped, _ = W.apply_schema_map(sales, ["sale_id"])
    row = mapped.filter("sale_id = 0").first().asDict()
    assert row.pop("TARGET") == pytest.approx(np.log1p(1_350_000))
    assert row == {"sale_id": 0, "borough_name": "Manhattan", "land_sqft": 1900, "property_sqft": 1150,
                   "property_type": "R4", "year_built": 1931, "zip_code": 10009}
    assert mapped.columns[1:-1] == W.MAPPED_FEATURES


def test_missing_values(spark):
    df = spark.createDataFrame(
        [("1", " -  ", "R4", "900", "1", "1950", "1"), ("1", "500,000", None, "900", "1", "1950", "1"),
         ("9", "500,000", "R4", "x", "1", None, "1")],
        "BOROUGH string, `SALE PRICE ` string, `BUILDING CLASS CATEGORY` string, `GROSS SQUARE FEET` string, "
        "`LAND SQUARE FEET` string, `YEAR BUILT` string, `ZIP CODE` string")
    mapped, report = W.apply_schema_map(df, [])
    assert report.first()["drop_reasons"] == {"non_residential_class": 1}
    rows = sorted(mapped.collect(), key=lambda r: str(r["borough_name"]))
    assert rows[0]["TARGET"] is None and rows[0]["borough_name"] == "Manhattan"
    assert rows[1]["borough_name"] is None and rows[1]["property_sqft"] is None and rows[1]["year_built"] is None


def test_empty_report(sales):
    mapped, report = W.apply_schema_map(sales.filter("false"), ["sale_id"])
    row = report.first()
    assert (row["n_raw"], row["n_scored"], row["n_dropped"], mapped.count()) == (0, 0, 0, 0)
    dependence.check_target_independence(mapped, NUMERIC, "TARGET")


@pytest.mark.parametrize("name", sorted(FORBIDDEN_COLUMNS))
def test_forbidden_columns(sales, name):
    mapped, _ = W.apply_schema_map(sales, ["sale_id"])
    G.check_no_forbidden_columns(mapped.drop("TARGET"))
    with pytest.raises(G.LeakageError, match=name):
        G.check_no_forbidden_columns(mapped.drop("TARGET").withColumn(name, F.lit(1.0)))


@pytest.mark.parametrize("name", sorted(LEAKY_FEATURES))
def test_leaky_names(name):
    G.assert_no_leakage(["BEDS", "PRICE"])
    with pytest.raises(G.LeakageError, match=name):
        G.assert_no_leakage(["BEDS", name])


def test_smuggled_targets_are_caught(sales):
    mapped, _ = W.apply_schema_map(sales, ["sale_id"])
    dependence.check_target_independence(mapped, NUMERIC, "TARGET")
    for copy in (F.col("TARGET") + F.rand(0) * 1e-9, F.expm1("TARGET"), -F.col("TARGET")):
        with pytest.raises(G.LeakageError, match="correlated"):
            dependence.check_target_independence(mapped.withColumn("index", copy), [*NUMERIC, "index"], "TARGET")


def test_dependence_of_constants_and_noise(spark):
    rng = np.random.default_rng(0)
    rows = [(1.0, float(rng.normal()), float(rng.normal()), None if i % 3 else 1.0) for i in range(500)]
    df = spark.createDataFrame(rows, "flat double, noise double, y double, rare double")
    got = {r["feature"]: r for r in dependence.dependence_scores(df, ["flat", "noise", "rare"], "y").collect()}
    assert got["flat"]["spearman"] is None and got["flat"]["nmi"] == 0 and not got["flat"]["flagged"]
    assert got["noise"]["nmi"] < 0.2 and not got["noise"]["flagged"]
    assert got["rare"]["n"] == 167


def test_mapping_is_stateless(sales):
    noise = sales.select("sale_id", (F.lit(700000) + F.col("sale_id")).alias("SALE PRICE"))

    def features(df):
        return W.apply_schema_map(df, ["sale_id"])[0].drop("TARGET")

    got = G.check_statelessness(features, sales, "sale_id", "SALE PRICE", noise)
    assert {r["invariant"]: r["holds"] for r in got.collect()} == dict.fromkeys(
        ["deterministic", "subset", "column_order", "target_shuffle"], True)

    def encoded(df):
        mean = df.agg(F.avg("SALE PRICE")).first()[0]
        return features(df).withColumn("leak", F.lit(mean))

    broken = {r["invariant"]: r["holds"] for r in
              G.check_statelessness(encoded, sales, "sale_id", "SALE PRICE", noise).collect()}
    assert not broken["subset"] and not broken["target_shuffle"]


def test_statelessness_reads_its_input_once(spark, sales):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    once = sales.mapInArrow(counted, sales.schema)
    noise = sales.select("sale_id", (F.lit(700000) + F.col("sale_id")).alias("SALE PRICE"))
    got = G.check_statelessness(lambda df: W.apply_schema_map(df, ["sale_id"])[0].drop("TARGET"), once, "sale_id", "SALE PRICE", noise)
    assert got.filter("holds").count() == 4 and read.value == sales.count()


def test_filters_ignore_price_values_in_range(sales):
    in_range = F.col("SALE PRICE").between(10000, 100000000)
    moved = sales.withColumn("SALE PRICE", F.when(in_range, F.lit(777777)).otherwise(F.col("SALE PRICE")))
    a, b = (W.apply_schema_map(df, [])[1].first()["drop_reasons"] for df in (sales, moved))
    assert {k: v for k, v in a.items() if "price" not in k} == {k: v for k, v in b.items() if "price" not in k}


def test_contract_lock_and_schema_difference(spark, sales):
    text = "the contract"
    good = hashlib.sha256(text.encode()).hexdigest()
    assert G.contract_lock(spark, text, "v1", {"v1": good}).first()["locked"]
    assert not G.contract_lock(spark, text + "!", "v1", {"v1": good}).first()["locked"]
    assert not G.contract_lock(spark, text, "v2", {"v1": good}).first()["locked"]
    missing, extra = G.schema_difference(sales, ["sale_id", "BOROUGH", "other"])
    assert missing == ["other"] and "SALE PRICE" in extra
    assert G.schema_difference_table(sales, ["other"]).filter("status = 'missing'").first()["column"] == "other"


def test_tripwire():
    assert G.leakage_tripwire(0.951)["triggered"] and not G.leakage_tripwire(0.95)["triggered"]
    assert not G.leakage_tripwire(None)["triggered"]
