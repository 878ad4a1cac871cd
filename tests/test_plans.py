"""Shapes of the physical plans that large data depends on."""

import os

import pytest
from pyspark.sql import functions as F

from acreage.operators import features as P, firewall as W, metrics as E
from acreage.operators.spatial import nearest_station_distance
from acreage.plans.listings import clean_listings
from acreage.session import release, shared_dir, stage
from acreage.sources import adapters as A

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executions(spark):
    """Executions that Spark still lists, by id; it forgets old ones, so their number says nothing."""
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {e.executionId(): e for e in (listed.apply(i) for i in range(listed.size()))}


def executed(spark, run):
    """Plans of every job that `run` starts."""
    last = max(executions(spark), default=-1)
    run()
    return [e.physicalPlanDescription() for i, e in sorted(executions(spark).items()) if i > last]


def test_no_pairing_of_everything(spark):
    def run():
        nearest_station_distance(A.listings(spark, FOLDER), A.stations(spark, FOLDER)).collect()
        clean_listings(A.listings(spark, FOLDER), ["listing_id"]).collect()

    plans = executed(spark, run)
    assert len(plans) > 5
    assert not [p for p in plans if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p or "EvalPython" in p]


def test_mapping_is_one_scan_without_a_shuffle(spark, tmp_path):
    A.rolling_sales(spark, FOLDER).write.parquet(str(tmp_path / "sales"))
    raw = spark.read.parquet(str(tmp_path / "sales"))
    text = plan(W.apply_schema_map(raw, ["sale_id"], W.UNDERSCORED)[0])
    assert text.count("FileScan") == 1 and "Exchange" not in text
    assert text.count("regexp_extract(replace(cast(SALE_PRICE") <= 1


def test_metrics_shuffle_counts_only(spark, tmp_path):
    A.scored(spark, FOLDER).write.parquet(str(tmp_path / "scored"))
    text = plan(E.evaluate_classifier(spark.read.parquet(str(tmp_path / "scored")), "y_true", "y_pred"))
    assert "ReadSchema: struct<y_true:int,y_pred:int>" in text
    assert text.index("partial_count") > text.index("Exchange")


def test_top_values_are_limited_before_the_shuffle(listings):
    assert "WindowGroupLimit" in plan(P.top_values(listings, ["ZIPCODE"], 50))


def test_staged_tables_live_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    table = stage(spark.range(10).withColumn("wide", F.lit("x")), "probe")
    assert [f for f in os.listdir(named) if f.startswith("probe-")]
    assert "ReadSchema: struct<id:bigint>" in plan(table.select("id"))
    release(spark)
    assert not [f for f in os.listdir(named) if f.startswith("probe-")]


def test_a_cluster_needs_the_setting():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
