import math
import random
import re

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from acreage.constants import PRICE_ZONE_EDGES, PRICE_ZONES
from acreage.functions import geo, scalar as X


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_zipcode(spark):
    got = apply(spark, X.zipcode, ["11104.0", "10461", "0042", "88888", None, "no654321."])
    assert got == ["11104", "10461", "00000", "88888", "00000", "65432"]


def test_borough_keeps_unknown_values(spark):
    got = apply(spark, X.borough_name, ["richmond county", "queens", "kings county", "Yonkers", None])
    assert got == ["staten island", "queens", "brooklyn", "Yonkers", None]


def test_text_and_type(spark):
    assert apply(spark, X.clean_text, ["TownHouse\t", " LOFT", "\n Multi-Family ", None]) == ["townhouse", "loft", "multi-family", None]
    got = apply(spark, X.property_type, ["loft for sale", "townhouse for rent", "for rent board", "condo"])
    assert got == ["loft", "townhouse", "for rent board", "condo"]


def test_cut_is_right_closed_and_includes_the_lowest(spark):
    values = [0.0, 500000.0, 500000.01, 1e6, 2e6, 2000000.5, float("inf"), -1.0, None]
    got = apply(spark, lambda c: X.cut(c, PRICE_ZONE_EDGES, PRICE_ZONES), values, "double")
    want = pd.cut(pd.Series(values, dtype=float), PRICE_ZONE_EDGES, labels=PRICE_ZONES, include_lowest=True)
    assert got == [None if pd.isna(w) else w for w in want]


def test_clip_keeps_null(spark):
    assert apply(spark, lambda c: X.clip(c, 1.0, 5.0), [0.0, 3.0, 9.0, None], "double") == [1.0, 3.0, 5.0, None]


def test_coordinate_key_rounds_like_numpy(spark):
    rng = random.Random(1)
    values = [rng.uniform(-75, 41) for _ in range(500)] + [40.00005, 40.00015, -73.99995]
    got = apply(spark, X.coordinate_key, values, "double")
    assert got == [round(float(v) * 10000) for v in values]


@pytest.mark.parametrize("text", [
    "1,234", " 2,500 ", "-", " -  ", "", "1e5", "+3", ".5", "5.", "12d", "nan", "inf", "-Infinity", "0x10", "1 2", None])
def test_coerce_number_matches_pandas(spark, text):
    got = apply(spark, X.coerce_number, [text])[0]
    cleaned = pd.Series([text], dtype=object).astype(str).str.replace(",", "", regex=False).str.strip()
    want = float(pd.to_numeric(cleaned, errors="coerce")[0])
    assert (got is None and math.isnan(want)) or got == want


def test_coerce_number_leaves_numbers(spark):
    assert apply(spark, lambda c: X.coerce_number(c, T.LongType()), [3, None], "long") == [3.0, None]


def test_argmax_takes_the_first(spark):
    rows = [[0.2, 0.4, 0.4], [0.5, 0.25, 0.25]]
    assert apply(spark, X.argmax, rows, "array<double>") == [1, 0]
    assert apply(spark, lambda c: X.thresholded_argmax(c, [0.5, 0.8, 0.5]), rows, "array<double>") == [2, 0]


def test_haversine(spark):
    df = spark.range(1).select(
        geo.haversine(40.872, -73.861, 40.872, -73.861).alias("same"),
        geo.haversine(0.0, 10.0, 0.0, 11.0).alias("apart"))
    row = df.first()
    assert row["same"] == 0 and abs(row["apart"] - 2 * math.pi * 6371.0 / 360) < 0.5


def test_hex_cells_group_near_points(spark):
    df = spark.createDataFrame([(40.7580, -73.9855), (40.7581, -73.9856), (40.9, -73.7)], "lat double, lon double")
    cells = [r[0] for r in df.select(geo.hex_cell(F.col("lat"), F.col("lon"))).collect()]
    assert cells[0] == cells[1] == "0_0" and cells[2] != cells[0]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a")], "x double, s string")
    assert X.nulls_for_nan(df).first()["x"] is None


TEXT = st.text(st.sampled_from("0123456789 .-ab"), max_size=12)
PRICE = st.one_of(st.none(), st.floats(-1e7, 1e7), st.sampled_from([0.0, 5e5, 1e6, 2e6, 2000000.0000001]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXT, PRICE), min_size=20, max_size=60))
def test_expressions_follow_a_plain_model(spark, rows):
    df = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rows)], "i int, t string, p double")
    got = df.orderBy("i").select(
        X.zipcode(F.col("t")), X.cut(F.col("p"), PRICE_ZONE_EDGES, PRICE_ZONES), X.nearest_hundred(F.col("p"))).collect()
    for (text, price), (code, zone, hundred) in zip(rows, got):
        found = re.search(r"\d{5}", text)
        assert code == (found.group() if found else "00000")
        inside = price is not None and price >= 0
        assert zone == (PRICE_ZONES[sum(price > e for e in PRICE_ZONE_EDGES[1:-1])] if inside else None)
        if price is not None and abs(price / 100 % 1 - 0.5) > 1e-6:
            assert hundred == round(price, -2)
