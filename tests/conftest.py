import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acreage.session import build_session, release  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def drop_kept_tables():
    yield
    release()


LISTING_SCHEMA = (
    "listing_id long, PRICE double, BEDS double, BATH double, PROPERTYSQFT double, LATITUDE double, "
    "LONGITUDE double, BOROUGH string, TYPE string, SUBLOCALITY string, ZIPCODE string, PROPERTY_CATEGORY string"
)


@pytest.fixture
def listings(spark):
    return spark.createDataFrame([
        (1, 415_000.0, 1.0, 1.0, 640.0, 40.872, -73.861, "the bronx", "co-op", "pelham bay", "10461", "residential"),
        (2, 885_000.0, 2.0, 2.0, 1010.0, 40.744, -73.921, "queens", "condo", "sunnyside", "11104", "residential"),
        (3, 1_630_000.0, 5.0, 2.0, 2750.0, 40.652, -73.962, "brooklyn", "house", "flatbush", "11226", "residential"),
        (4, 349_000.0, 3.0, 1.5, 1180.0, 40.611, -74.091, "staten island", "townhouse", "rosebank", "10305", "residential"),
        (5, 3_890_000.0, 4.0, 3.5, 3900.0, 40.776, -73.957, "manhattan", "condo", "yorkville", "10028", "residential"),
    ], LISTING_SCHEMA)


def sales_rows():
    """Fifteen sales that the contract keeps, three per borough, and nine it drops."""
    rng = random.Random(11)

    def sale(borough, category="R4 CONDOMINIUMS", **changed):
        values = {
            "gross": 100 * rng.randint(6, 25), "land": 100 * rng.randint(8, 45), "year": rng.randint(1915, 2015),
            "zipcode": 10000 + 100 * borough + rng.randint(1, 90), "price": 5000 * rng.randint(60, 500), **changed}
        return (borough, category, values["gross"], values["land"], values["year"], values["zipcode"], values["price"])

    kept = [sale(b, f"R{4 + (b + i) % 4} CONDOMINIUMS") for b in range(1, 6) for i in range(3)]
    kept[0] = (1, "R4 CONDOMINIUMS", 1150, 1900, 1931, 10009, 1_350_000)
    dropped = [
        sale(1, price=0), sale(2, price=9_999), sale(3, price=100_000_001), sale(4, gross=0), sale(5, year=0),
        *[sale(b, name) for b, name in enumerate(["07 RENTALS", "22 STORES", "44 CONDO PARKING", "nan"], 1)],
    ]
    return kept + dropped


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(sales_rows())],
        "sale_id long, BOROUGH long, `BUILDING CLASS CATEGORY` string, `GROSS SQUARE FEET` long, "
        "`LAND SQUARE FEET` long, `YEAR BUILT` long, `ZIP CODE` long, `SALE PRICE` long",
    )


@pytest.fixture
def make_listings(spark):
    """Seeded listings whose price follows size and distance, so that models can learn it."""
    import numpy as np

    def make(n=400, seed=0):
        rng = np.random.default_rng(seed)
        names = ["staten island", "the bronx", "queens", "brooklyn", "manhattan"]
        kinds = ["co-op", "condo", "townhouse", "multi-family home", "house"]
        rows = []
        for i in range(n):
            place, size = int(rng.integers(5)), float(np.round(rng.triangular(350, 1200, 4200)))
            price = float(np.round(90_000 + size * (300 + 170 * place) * rng.uniform(0.92, 1.08)))
            rows.append((
                i, price, float(1 + rng.binomial(6, 0.35)), float(1 + rng.integers(0, 6) / 2), size,
                float(rng.uniform(40.56, 40.88)), float(rng.uniform(-74.16, -73.76)), names[place],
                kinds[i % 5], f"quarter {i % 6}", str(10100 + i % 7), "residential"))
        return spark.createDataFrame(rows, LISTING_SCHEMA)

    return make
