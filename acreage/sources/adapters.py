"""Bindings of the driver's star-schema tables to listings, sales, scored rows, stations, requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _orders_with_region(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
    )


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw listings with nulls, outliers, unmapped boroughs, exact and near duplicates."""
    base = _orders_with_region(spark, folder).selectExpr(
        "o_orderkey AS listing_id",
        "o_totalprice * 8D AS PRICE",
        "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 6 AS DOUBLE) END AS BEDS",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST((o_orderkey * 31) % 9 AS DOUBLE) / 2D END AS BATH",
        """CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN 60000D
            WHEN o_orderkey % 103 = 0 THEN 0D
            ELSE CAST(400 + (o_orderkey * 37) % 3600 AS DOUBLE) END AS PROPERTYSQFT""",
        "CAST(404000 + (o_orderkey * 7919) % 5600 AS DOUBLE) / 10000D AS LATITUDE",
        "CAST(-743000 + (o_orderkey * 104729) % 7200 AS DOUBLE) / 10000D AS LONGITUDE",
        """CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN n_regionkey = 0 THEN 'New York County'
            WHEN n_regionkey = 1 THEN ' Kings County ' WHEN n_regionkey = 2 THEN 'QUEENS'
            WHEN n_regionkey = 3 THEN 'The Bronx' ELSE 'Elsewhere' END AS BOROUGH""",
        "concat('  ', o_orderpriority, ' For Sale ') AS TYPE",
        "concat('Sub ', CAST(o_custkey % 120 AS STRING)) AS SUBLOCALITY",
        """CASE WHEN o_custkey % 4 = 0 THEN CAST(10000 + o_custkey AS STRING)
            WHEN o_custkey % 4 = 1 THEN concat(CAST(10000 + o_custkey AS STRING), '.0')
            WHEN o_custkey % 4 = 2 THEN concat(CAST(10000 + o_custkey AS STRING), '-1234')
            ELSE CAST(o_custkey AS STRING) END AS ZIPCODE""",
        "'residential' AS PROPERTY_CATEGORY",
    )
    # each row comes once, again if it has an exact copy, and shifted if it has a near copy
    exact, near = F.col("listing_id") % 50 == 0, F.col("listing_id") % 75 == 0
    copies = F.explode(
        F.when(exact & near, F.array(F.lit(0), F.lit(1), F.lit(2))).when(exact, F.array(F.lit(0), F.lit(1)))
        .when(near, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0))))
    shifted = F.col("_copy") == 2
    return base.withColumn("_copy", copies).withColumns({
        "listing_id": F.when(shifted, F.col("listing_id") + 100_000_000).otherwise(F.col("listing_id")),
        "LATITUDE": F.when(shifted, F.col("LATITUDE") + F.lit(1.0) / F.lit(100000.0)).otherwise(F.col("LATITUDE")),
    }).drop("_copy")


def rolling_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Raw sales with text numbers, blanks, dashes and every drop reason."""
    return _orders_with_region(spark, folder).selectExpr(
        "o_orderkey AS k", "CAST(floor(o_totalprice * 8D) AS BIGINT) AS p", "n_regionkey"
    ).selectExpr(
        "k AS sale_id",
        "n_regionkey + 1 AS BOROUGH",
        """CASE WHEN k % 41 = 0 THEN NULL WHEN k % 5 = 0 THEN '01 ONE FAMILY DWELLINGS'
            WHEN k % 5 = 1 THEN ' R4 CONDOMINIUMS' WHEN k % 5 = 2 THEN 'R6 CONDOMINIUMS'
            WHEN k % 5 = 3 THEN '21 OFFICE BUILDINGS' ELSE 'R5 CONDOMINIUMS' END AS BUILDING_CLASS_CATEGORY""",
        """CASE WHEN k % 31 = 0 THEN '0'
            ELSE concat('1,', lpad(CAST(k % 1000 AS STRING), 3, '0')) END AS GROSS_SQUARE_FEET""",
        "concat(' 2,', lpad(CAST((k * 7) % 1000 AS STRING), 3, '0'), ' ') AS LAND_SQUARE_FEET",
        "CASE WHEN k % 37 = 0 THEN 0 ELSE 1900 + k % 120 END AS YEAR_BUILT",
        "10000 + k % 1700 AS ZIP_CODE",
        """CASE WHEN k % 11 = 0 THEN '0' WHEN k % 13 = 0 THEN '1' WHEN k % 97 = 0 THEN '250,000,000'
            WHEN k % 29 = 0 THEN ' -  '
            WHEN p >= 1000 THEN concat(CAST(p DIV 1000 AS STRING), ',', lpad(CAST(p % 1000 AS STRING), 3, '0'))
            ELSE CAST(p AS STRING) END AS SALE_PRICE""",
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labels, predictions, probabilities `p0`..`p3` and prices of a four-class task."""
    weights = ["(k * 3)", "(k * 7)", "(k * 9)", "(k * 13)"]
    return (
        _orders_with_region(spark, folder)
        .selectExpr("o_orderkey AS k", "o_totalprice * 8D AS price", "n_regionkey AS grp")
        .selectExpr("*", "CASE WHEN price <= 500000 THEN 0 WHEN price <= 1000000 THEN 1 "
                         "WHEN price <= 2000000 THEN 2 ELSE 3 END AS y_true")
        .selectExpr("*", "CASE WHEN k % 7 = 0 THEN (y_true + 1) % 4 WHEN k % 11 = 0 THEN 0 ELSE y_true END AS y_pred")
        .selectExpr("*", *[
            f"1 + {w} % 10 + CASE WHEN y_pred = {i} THEN 8 ELSE 0 END AS w{i}" for i, w in enumerate(weights)
        ])
        .selectExpr(
            "k AS row_id", "grp", "y_true", "y_pred",
            *[f"CAST(w{i} AS DOUBLE) / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p{i}" for i in range(4)],
            "price", "price * (1D + CAST(k % 21 - 10 AS DOUBLE) / 100D) AS price_pred",
        )
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "CAST(404000 + (s_suppkey * 911) % 5500 AS DOUBLE) / 10000D AS latitude",
        "CAST(-743000 + (s_suppkey * 1777) % 7000 AS DOUBLE) / 10000D AS longitude",
    )


def attributions(spark: SparkSession, folder: str) -> DataFrame:
    """Vector elements as attributions, one feature per position."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.posexplode("embedding").alias("_pos", "_value")
    ).select(
        "row_id", F.format_string("f%03d", F.col("_pos")).alias("feature"),
        F.col("_value").cast("double").alias("value"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring requests from events, some of them out of range."""
    return table(spark, folder, "events").transform(requests_from_events)


def requests_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS request_id",
        "ts",
        "CAST(user_id % 23 AS INT) AS beds",
        "CAST(event_id % 33 AS DOUBLE) / 2D AS bath",
        "value * 100D AS propertysqft",
        "CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN 'Manhattan' ELSE 'Queens' END AS borough",
        "CASE WHEN event_id % 2 = 0 THEN 'Condo' ELSE 'House' END AS type",
        "CASE WHEN event_id % 29 = 0 THEN 'abc' ELSE CAST(10000 + user_id AS STRING) END AS zipcode",
        "CAST(404000 + (event_id * 7919) % 5600 AS DOUBLE) / 10000D AS latitude",
        "CAST(-743000 + (event_id * 104729) % 7200 AS DOUBLE) / 10000D AS longitude",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('Sub ', CAST(user_id % 120 AS STRING)) END AS sublocality",
    )
