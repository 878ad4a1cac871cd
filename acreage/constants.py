"""Fixed values shared by the whole package."""

from __future__ import annotations

# Every number, label and spelling below must equal the published definition.
SEED = 42
TEST_SHARE = 0.2
CV_FOLDS = 5
SEARCH_TRIALS = 50

EARTH_RADIUS_KM = 6371.0
MANHATTAN_CENTER = (40.7580, -73.9855)
CENTRAL_PARK = (40.7829, -73.9654)
REFERENCE_POINTS = {"MANHATTAN_CENTER": MANHATTAN_CENTER, "CENTRAL_PARK": CENTRAL_PARK}
LATITUDE_RANGE = (40.4, 40.95)
LONGITUDE_RANGE = (-74.3, -73.6)

PRICE_ZONE_EDGES = [0.0, 500_000.0, 1_000_000.0, 2_000_000.0, float("inf")]
PRICE_ZONES = ["Low", "Medium", "High", "Very High"]
SQFT_EDGES = [0.0, 1_000.0, 2_000.0, float("inf")]
SQFT_CATEGORIES = ["Small", "Medium", "Large"]

NUMERIC_FEATURES = [
    "BEDS", "BATH", "PROPERTYSQFT", "TOTAL_ROOMS", "BED_BATH_RATIO", "LOG_SQFT",
    "ROOMS_PER_SQFT", "DIST_MANHATTAN_CENTER", "DIST_CENTRAL_PARK", "DIST_NEAREST_SUBWAY",
]
ONEHOT_FEATURES = ["BOROUGH", "TYPE", "PROPERTY_CATEGORY"]
TARGET_ENCODED_FEATURES = ["ZIPCODE", "SUBLOCALITY"]
ALL_FEATURES = NUMERIC_FEATURES + ONEHOT_FEATURES + TARGET_ENCODED_FEATURES

BOROUGH_SPELLINGS = {
    "new york county": "manhattan",
    "kings county": "brooklyn",
    "queens county": "queens",
    "bronx county": "the bronx",
    "richmond county": "staten island",
    "manhattan": "manhattan",
    "brooklyn": "brooklyn",
    "queens": "queens",
    "the bronx": "the bronx",
    "staten island": "staten island",
}
BOROUGH_CODES = {1: "Manhattan", 2: "Bronx", 3: "Brooklyn", 4: "Queens", 5: "Staten Island"}

LEAKY_FEATURES = {"PRICE_PER_SQFT", "price_per_sqft", "LOG_PRICE", "log_price", "PRICE_ZONE"}
FORBIDDEN_COLUMNS = {"SALE PRICE", "SALE DATE", "PRICE_PER_SQFT", "TARGET", "log_price"}
REQUIRED_COLUMNS = ["BATH", "BEDS", "BOROUGH", "LATITUDE", "LONGITUDE", "PRICE", "PROPERTYSQFT"]
HEADER_ROW_CANDIDATES = (4, 3, 5)
# End of fixed values.
