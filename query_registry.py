"""Every operator as a query over the driver's tables: name -> fn(spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.constants import ALL_FEATURES, HEADER_ROW_CANDIDATES, PRICE_ZONES
from acreage.functions import scalar as X
from acreage.functions.geo import hex_cell
from acreage.ml import training as T
from acreage.ml.attributions import tree_attributions, tree_outputs
from acreage.ml.clusters import add_neighborhood_clusters
from acreage.ml.neighbours import nearest_rows
from acreage.ml.resample import oversample_and_edit
from acreage.ml.search import Whole
from acreage.operators import (
    cleaning as C, dependence, encoding, explain, features as P, firewall as W, guards, metrics as E,
    monitoring as M, ranking as R, scoring as S, thresholds as H,
)
from acreage.operators.spatial import nearest_station_distance
from acreage.plans import firewall as PF, listings as L, scoring as PS, training as PT
from acreage.session import shared_dir, stage
from acreage.sources import adapters as A, files, workbooks
from acreage.sources.files import load_baseline, save_baseline, union_by_name
from acreage.streaming import jobs as S2

Query = Callable[[SparkSession, str], DataFrame]
LISTING = ["listing_id", "PRICE", "BEDS", "BATH", "PROPERTYSQFT", "LATITUDE", "LONGITUDE", "BOROUGH",
           "TYPE", "SUBLOCALITY", "ZIPCODE", "PROPERTY_CATEGORY"]
QUERIES: dict[str, Query] = {}
BASELINE_END = "2024-01-16"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles so that the last bits of two engines' libraries do not matter."""
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def with_probabilities(df: DataFrame) -> DataFrame:
    return df.withColumn("probability", F.array("p0", "p1", "p2", "p3"))


def log_scored(spark: SparkSession, folder: str) -> DataFrame:
    return A.scored(spark, folder).select(
        "row_id", "grp", F.log1p("price").alias("y"), F.log1p("price_pred").alias("p")
    )


# --- cleaning -----------------------------------------------------------------------------------


@query
def clean_listings(spark, folder):
    return rounded(L.clean_listings(A.listings(spark, folder), ["listing_id"]).select(*LISTING), 4)


@query
def dedup_near(spark, folder):
    return C.deduplicate(A.listings(spark, folder), ["listing_id"]).select(*LISTING)


@query
def distinct_listings(spark, folder):
    return C.distinct_rows(A.listings(spark, folder)).select(*LISTING)


@query
def impute_group_median(spark, folder):
    return C.impute_missing(A.listings(spark, folder)).select("listing_id", "BOROUGH", "BEDS", "BATH", "PROPERTYSQFT")


@query
def cap_outliers_iqr(spark, folder):
    capped = C.cap_outliers(A.listings(spark, folder), factor=0.5)
    return rounded(capped.select("listing_id", "PRICE", "PROPERTYSQFT", "BEDS", "BATH"), 4)


@query
def normalize_text(spark, folder):
    return C.normalize_text_columns(A.listings(spark, folder)).select("listing_id", "BOROUGH", "TYPE", "SUBLOCALITY")


@query
def normalize_borough(spark, folder):
    return C.normalize_borough(A.listings(spark, folder)).select("listing_id", "BOROUGH")


@query
def normalize_zip(spark, folder):
    return C.normalize_zipcode(A.listings(spark, folder)).select("listing_id", "ZIPCODE")


@query
def normalize_type(spark, folder):
    return C.normalize_type(C.normalize_text_columns(A.listings(spark, folder))).select("listing_id", "TYPE")


@query
def filter_listings(spark, folder):
    return C.inside_city(C.positive_price_and_size(A.listings(spark, folder))).select("listing_id", "PRICE", "LATITUDE")


@query
def validate_issues(spark, folder):
    return M.validation_issues(A.listings(spark, folder).drop("BOROUGH"))


# --- features -----------------------------------------------------------------------------------


@query
def default_columns(spark, folder):
    bare = A.listings(spark, folder).drop("BOROUGH", "PROPERTY_CATEGORY")
    return P.add_default_columns(bare).select("listing_id", "BOROUGH", "PROPERTY_CATEGORY", "SUBLOCALITY")


@query
def numeric_features(spark, folder):
    out = P.add_numeric_features(A.listings(spark, folder))
    return rounded(out.select("listing_id", "TOTAL_ROOMS", "BED_BATH_RATIO", "LOG_SQFT", "ROOMS_PER_SQFT"))


@query
def target_zones(spark, folder):
    out = P.add_zone_code(P.add_target_variables(A.listings(spark, folder)))
    return rounded(out.select("listing_id", "PRICE_ZONE", "ZONE_CODE", "LOG_PRICE", "SQFT_CATEGORY"))


@query
def distance_features(spark, folder):
    out = P.add_subway_proxy(P.add_distance_features(A.listings(spark, folder)))
    return rounded(out.select("listing_id", "DIST_MANHATTAN_CENTER", "DIST_CENTRAL_PARK", "DIST_NEAREST_SUBWAY"))


@query
def nearest_station(spark, folder):
    out = nearest_station_distance(A.listings(spark, folder), A.stations(spark, folder))
    return rounded(out.select("listing_id", "DIST_NEAREST_SUBWAY"))


@query
def hex_bins(spark, folder):
    cell = hex_cell(F.col("LATITUDE"), F.col("LONGITUDE"), 1.2)
    return rounded(A.listings(spark, folder).groupBy(cell.alias("hex_cell")).agg(
        F.count("*").alias("n"), F.avg("PRICE").alias("avg_price")))


@query
def cap_cardinality(spark, folder):
    out = P.cap_categorical_cardinality(A.listings(spark, folder), ["SUBLOCALITY", "TYPE", "ZIPCODE"])
    return out.select("listing_id", "SUBLOCALITY", "TYPE", "ZIPCODE")


@query
def top_categories(spark, folder):
    return P.top_values(A.listings(spark, folder), ["SUBLOCALITY", "ZIPCODE"], 10)


@query
def canonical_categories(spark, folder):
    out = P.canonicalize_categories(A.listings(spark, folder))
    return out.select("listing_id", "BOROUGH", "TYPE", "PROPERTY_CATEGORY", "ZIPCODE", "SUBLOCALITY")


@query
def listing_features(spark, folder):
    out = L.feature_pipeline(
        A.listings(spark, folder), A.stations(spark, folder), clusters=None, keys=["listing_id"])
    return rounded(out.select(
        "listing_id", "TOTAL_ROOMS", "ROOMS_PER_SQFT", "DIST_CENTRAL_PARK", "DIST_NEAREST_SUBWAY",
        "HEX_CELL", "PRICE_ZONE", "LOG_PRICE", "SQFT_CATEGORY", "SUBLOCALITY", "ZIPCODE"))


@query
def labelled_listings(spark, folder):
    return P.drop_missing_targets(P.add_target_variables(
        A.listings(spark, folder).withColumn("PRICE", F.when(F.col("BEDS").isNotNull(), F.col("PRICE"))))
    ).select("listing_id", "PRICE_ZONE")


@query
def training_data(spark, folder):
    cleaned = L.clean_listings(A.listings(spark, folder), ["listing_id"])
    out = L.prepare_training_data(cleaned, clusters=None)
    return rounded(P.model_features(out, ["LISTING_ID", "PRICE_ZONE", "ZONE_CODE", "LOG_PRICE"]))


@query
def zone_share(spark, folder):
    cleaned = L.clean_listings(A.listings(spark, folder), ["listing_id"])
    derived = cleaned.transform(P.add_numeric_features).transform(P.add_distance_features)
    return rounded(M.zone_share(P.add_target_variables(derived), ["BOROUGH"]))


@query
def price_histogram(spark, folder):
    return M.histogram(A.listings(spark, folder), "PRICE", 50)


@query
def profile(spark, folder):
    return M.profile(A.listings(spark, folder), ["BOROUGH", "TYPE", "SUBLOCALITY", "ZIPCODE"])


@query
def cleaning_summary(spark, folder):
    raw = A.listings(spark, folder)
    return M.cleaning_summary(raw, L.clean_listings(raw, ["listing_id"]))


# --- firewall -----------------------------------------------------------------------------------


@query
def coerce_numeric(spark, folder):
    sales = A.rolling_sales(spark, folder)
    return sales.select("sale_id", *[
        X.coerce_number(F.col(c), sales.schema[c].dataType).alias(c)
        for c in ("SALE_PRICE", "GROSS_SQUARE_FEET", "LAND_SQUARE_FEET", "YEAR_BUILT")])


@query
def drop_engine(spark, folder):
    return W.run_drop_engine(A.rolling_sales(spark, folder), W.UNDERSCORED).select("sale_id", "drop_reason")


@query
def drop_reasons(spark, folder):
    return W.drop_reason_counts(W.run_drop_engine(A.rolling_sales(spark, folder), W.UNDERSCORED))


@query
def drop_log(spark, folder):
    _, report = W.apply_schema_map(A.rolling_sales(spark, folder), ["sale_id"], W.UNDERSCORED)
    return guards.drop_log_consistent(report)


@query
def map_features(spark, folder):
    mapped, _ = W.apply_schema_map(A.rolling_sales(spark, folder), ["sale_id"], W.UNDERSCORED)
    return rounded(mapped)


@query
def leakage_scores(spark, folder):
    mapped, _ = W.apply_schema_map(A.rolling_sales(spark, folder), ["sale_id"], W.UNDERSCORED)
    watched = mapped.withColumn("smuggled", F.expm1("TARGET"))
    names = ["land_sqft", "property_sqft", "year_built", "zip_code", "smuggled"]
    return rounded(dependence.dependence_scores(watched, names, "TARGET"))


@query
def prediction_health(spark, folder):
    return rounded(M.prediction_health(A.scored(spark, folder), "price_pred"))


@query
def log_space_r2(spark, folder):
    out = E.log_space_r2(log_scored(spark, folder), "y", "p")
    return rounded(out.withColumn("triggered", F.col("r2_log_space") > 0.95))


@query
def kept_in_both(spark, folder):
    sales = A.rolling_sales(spark, folder)
    a, _ = W.apply_schema_map(sales, ["sale_id"], W.UNDERSCORED)
    unsold = F.col("YEAR_BUILT") < 1950
    moved = sales.withColumn("SALE_PRICE", F.when(unsold, F.lit("0")).otherwise(F.col("SALE_PRICE")))
    b, _ = W.apply_schema_map(moved, ["sale_id"], W.UNDERSCORED)
    return guards.kept_in_both(a, b, "sale_id").select("sale_id", "borough_name", "property_sqft")


@query
def contract_locks(spark, folder):
    texts = A.table(spark, folder, "documents").select(F.col("doc_id").alias("version"), "text", "lang")
    registry = texts.filter(F.col("lang") != "de").select("version", F.sha2(F.trim("text"), 256).alias("sha256"))
    return guards.contract_locks(texts, registry)


@query
def union_files(spark, folder):
    sales = A.rolling_sales(spark, folder)
    parts = [sales.filter(F.col("BOROUGH") == b) for b in range(1, 5)]
    last = sales.filter(F.col("BOROUGH") == 5).drop("YEAR_BUILT")
    return union_by_name([*parts, last]).select("sale_id", "BOROUGH", "YEAR_BUILT", "ZIP_CODE", "SALE_PRICE")


# --- metrics ------------------------------------------------------------------------------------


@query
def confusion(spark, folder):
    return E.confusion(A.scored(spark, folder), "y_true", "y_pred")


@query
def confusion_matrix(spark, folder):
    wide = E.confusion_matrix(A.scored(spark, folder), "y_true", "y_pred", [0, 1, 2, 3])
    return wide.toDF("y_true", "n0", "n1", "n2", "n3")


@query
def classifier_metrics(spark, folder):
    return rounded(E.evaluate_classifier(A.scored(spark, folder), "y_true", "y_pred"))


@query
def class_report(spark, folder):
    return rounded(E.class_report(A.scored(spark, folder), "y_true", "y_pred"))


@query
def regressor_metrics(spark, folder):
    return rounded(E.evaluate_regressor(log_scored(spark, folder), "y", "p"), 4)


@query
def fairness(spark, folder):
    return rounded(E.evaluate_by_group(A.scored(spark, folder), "y_true", "y_pred", "grp"))


@query
def class_weights(spark, folder):
    return rounded(E.class_weights(A.table(spark, folder, "labels"), "quality"))


@query
def focal_loss(spark, folder):
    df = with_probabilities(A.scored(spark, folder)).withColumns({
        "y": F.log1p("price"), "p": F.log1p("price_pred")})
    return rounded(E.multitask_loss(df, "y_true", "probability", "y", "p", alpha=[1.0, 2.0, 0.5, 1.5]))


@query
def apply_thresholds(spark, folder):
    df = with_probabilities(A.scored(spark, folder))
    return df.select(
        "row_id", X.argmax(F.col("probability")).alias("plain"),
        H.predict_with_thresholds(
            F.col("probability"), {"Low": 0.2, "Medium": 0.7, "Very High": 0.4}, PRICE_ZONES).alias("tuned"))


@query
def tune_thresholds(spark, folder):
    return rounded(H.optimize_thresholds(
        with_probabilities(A.scored(spark, folder)), "probability", "y_true", PRICE_ZONES))


@query
def best_model(spark, folder):
    df = with_probabilities(A.scored(spark, folder)).withColumn("argmax", X.argmax(F.col("probability")))
    given = E.evaluate_classifier(df, "y_true", "y_pred").select(F.lit("given").alias("model"), "macro_f1", F.lit(0).alias("position"))
    plain = E.evaluate_classifier(df, "y_true", "argmax").select(F.lit("argmax").alias("model"), "macro_f1", F.lit(1).alias("position"))
    return rounded(E.best_model(given.unionByName(plain), "macro_f1"))


# --- splits, encoders, explanations ---------------------------------------------------------------


@query
def stratified_split(spark, folder):
    return R.stratified_split(A.scored(spark, folder), "row_id", "y_true").select("row_id", "y_true", "split")


@query
def split_labels(spark, folder):
    return R.stratified_split(A.table(spark, folder, "labels"), "doc_id", "quality").select("doc_id", "quality", "split")


@query
def kfold(spark, folder):
    return R.assign_folds(A.scored(spark, folder), "row_id", "y_true").select("row_id", "y_true", "fold")


@query
def plain_kfold(spark, folder):
    return R.assign_folds(A.scored(spark, folder), "row_id", None).select("row_id", "fold")


@query
def sample_rows(spark, folder):
    return R.sample_rows(A.scored(spark, folder), "row_id", 500).select("row_id", "y_true")


@query
def standardize(spark, folder):
    names = ["PRICE", "BEDS", "BATH", "PROPERTYSQFT"]
    out = encoding.standardize(A.listings(spark, folder), names)
    return rounded(out.select("listing_id", *["z_" + c for c in names]))


@query
def target_encode(spark, folder):
    df = A.listings(spark, folder).withColumn("LOG_PRICE", F.log1p("PRICE"))
    table, prior = encoding.target_encodings(df, ["ZIPCODE", "BOROUGH"], "LOG_PRICE")
    out = encoding.apply_target_encodings(df, table, prior, ["ZIPCODE", "BOROUGH"])
    return rounded(out.select("listing_id", "ZIPCODE_TE", "BOROUGH_TE"))


@query
def ordered_target_encode(spark, folder):
    df = C.distinct_rows(A.listings(spark, folder)).withColumn("LOG_PRICE", F.log1p("PRICE"))
    out = encoding.ordered_target_statistics(df, "listing_id", ["ZIPCODE", "BOROUGH"], "LOG_PRICE")
    return rounded(out.select("listing_id", "ZIPCODE_OTS", "BOROUGH_OTS"))


@query
def nearest_parts(spark, folder):
    """The five parts of a brand nearest by size and price; a part without a price has none."""
    parts = A.table(spark, folder, "part").withColumn("place", F.array(F.col("p_size").cast("double"), "p_retailprice"))
    return rounded(nearest_rows(parts, "p_partkey", "place", 5, 2, "p_brand"))


@query
def label_codes(spark, folder):
    return encoding.label_codes(P.add_target_variables(A.listings(spark, folder)), "PRICE_ZONE")


@query
def importance(spark, folder):
    return rounded(explain.global_importance(A.attributions(spark, folder)))


@query
def top_importance(spark, folder):
    return rounded(explain.global_importance(A.attributions(spark, folder), 10))


@query
def top_factors(spark, folder):
    return explain.top_factors(A.attributions(spark, folder), 5)


@query
def linear_attributions(spark, folder):
    df = A.listings(spark, folder).select("listing_id", "BEDS", "BATH", "PROPERTYSQFT").dropna()
    return rounded(explain.linear_attributions(
        df, "listing_id", {"BEDS": 0.125, "BATH": 0.25, "PROPERTYSQFT": 0.001}))


@query
def kernel_attributions(spark, folder):
    names = ["BEDS", "BATH", "PROPERTYSQFT"]
    df = A.listings(spark, folder).dropna(subset=names).groupBy("listing_id").agg(*[F.min(c).alias(c) for c in names])
    return rounded(explain.kernel_attributions(
        df, "listing_id", names,
        lambda d: d.withColumn("score", 0.125 * F.col("BEDS") + F.col("BATH") * F.col("PROPERTYSQFT") / 997)))


# --- records ------------------------------------------------------------------------------------


@query
def zone_record(spark, folder):
    record = S.zone_record(F.col("probability"))
    out = with_probabilities(A.scored(spark, folder)).select("row_id", record.alias("r"))
    return out.select(
        "row_id", "r.price_zone", "r.confidence",
        *[F.col("r.probabilities")[z].alias("p_" + z.lower().replace(" ", "_")) for z in PRICE_ZONES])


@query
def price_record(spark, folder):
    record = S.price_record(F.log1p(F.col("price_pred") + F.lit(0.123)))
    out = A.scored(spark, folder).select("row_id", record.alias("r"))
    return out.select("row_id", "r.predicted_price", "r.price_range.low", "r.price_range.high")


@query
def validate_requests(spark, folder):
    out = S.validate_requests(A.requests(spark, folder))
    return out.select("request_id", "sublocality", F.array_join("rejected", ",").alias("rejected"))


@query
def request_features(spark, folder):
    good, _ = S.split_requests(A.requests(spark, folder))
    return rounded(S.request_features(good, ["request_id"]))


# --- monitoring ---------------------------------------------------------------------------------


def _events(spark, folder):
    events = A.table(spark, folder, "events")
    old = F.col("ts") < F.lit(BASELINE_END).cast("timestamp")
    return events.filter(old), events.filter(~old)


@query
def feature_stats(spark, folder):
    return rounded(M.feature_stats(A.table(spark, folder, "events"), ["value", "user_id"]))


@query
def saved_baseline(spark, folder):
    path = f"{shared_dir(spark)}/baseline-{uuid.uuid4().hex}"
    save_baseline(M.feature_stats(A.listings(spark, folder), ["PRICE", "BEDS", "PROPERTYSQFT"]), path, "json")
    return rounded(load_baseline(spark, path, "json"), 4)


@query
def drift(spark, folder):
    old, new = _events(spark, folder)
    stats = M.feature_stats(old, ["value", "user_id", "event_id"])
    return rounded(M.detect_drift(new, stats, 0.001, ["value", "user_id", "event_id"]), 4)


@query
def drift_windowed(spark, folder):
    old, new = _events(spark, folder)
    stats = M.feature_stats(old, ["value", "user_id"])
    return rounded(M.windowed_drift(new, stats, "ts", ["value", "user_id"], "1 day"))


# --- models (no SQL equivalent) -------------------------------------------------------------------


def _training_rows(spark, folder):
    cleaned = L.clean_listings(A.listings(spark, folder), ["listing_id"])
    return T.add_class_weights(PT.training_table(cleaned, "LISTING_ID", clusters=None))


def _parts(spark, folder):
    rows = _training_rows(spark, folder)
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


#: The published search ranges with few boosting rounds.
SHORT_SPACE = {**T.BOOSTER_SPACE, "rounds": Whole(3, 3)}


def _small_models(train):
    models = T.fit_all({"zone": T.zone_pipeline(T.zone_forest(10, 6)), "price": T.price_pipeline(T.price_line())}, train)
    return models["zone"], models["price"]


@query
def kmeans_zones(spark, folder):
    clustered = add_neighborhood_clusters(A.listings(spark, folder), 15)
    return clustered.groupBy("NEIGHBORHOOD_CLUSTER").agg(F.count("*").alias("n"))


@query
def train_classifier(spark, folder):
    train, test = _parts(spark, folder)
    return rounded(T.train_classifiers(train, test, {
        "random_forest": T.zone_pipeline(T.zone_forest(20, 8)),
        "booster": T.zone_pipeline(T.zone_booster(5, 4)),
    }).metrics)


@query
def train_boosters(spark, folder):
    """The three published kinds of booster at their depth, leaves and rounds."""
    train, test = _parts(spark, folder)
    return rounded(T.train_classifiers(train, test, {
        "by_level": T.zone_pipeline(T.zone_booster()),
        "best_first": T.zone_pipeline(T.zone_booster(leaves=63, weight=T.WEIGHT)),
        "ordered": T.ordered_zone_pipeline(T.zone_booster(weight=T.WEIGHT), "LISTING_ID"),
    }).metrics)


@query
def train_fallback_onehot(spark, folder):
    train, test = _parts(spark, folder)
    return rounded(T.train_classifiers(train, test, {
        "random_forest": T.zone_pipeline(T.zone_forest(10, 6), fallback_onehot=True)}).metrics)


@query
def train_regressor(spark, folder):
    train, test = _parts(spark, folder)
    return rounded(T.train_regressors(train, test, {
        "random_forest": T.price_pipeline(T.price_forest(20, 8)),
        "booster": T.price_pipeline(T.price_booster(5, 4)),
        "line": T.price_pipeline(T.price_line()),
    }).metrics)


@query
def train_network(spark, folder):
    train, test = _parts(spark, folder)
    pipeline = T.network_pipeline(train, (32, 16), 20)
    return rounded(T.train_classifiers(train, test, {"network": pipeline}).metrics)


@query
def train_joint_network(spark, folder):
    """Both heads of the network at its published widths, with the combined loss on the test rows."""
    train, test = _parts(spark, folder)
    scored = T.joint_pipeline().fit(train).transform(test).withColumn("p", T.probabilities())
    scored = stage(scored.select(F.col(T.LABEL).cast("int").alias(T.LABEL), T.TARGET, "ZONE_PRED", "PRICE_PRED", "p"), "scored")
    parts = [E.multitask_loss(scored, T.LABEL, "p", T.TARGET, "PRICE_PRED"),
             E.evaluate_classifier(scored, T.LABEL, "ZONE_PRED").select("n", "accuracy", "macro_f1"),
             E.evaluate_regressor(scored, T.TARGET, "PRICE_PRED").select("r2")]
    first, *others = [p.withColumn("run", F.lit("joint")) for p in parts]  # one row each
    for other in others:
        first = first.join(other, "run")
    return rounded(first)


@query
def tune_classifier(spark, folder):
    train, _ = _parts(spark, folder)
    _, _, trials = T.tune_classifier(train, "LISTING_ID", trials=4, folds=2, space=SHORT_SPACE, startup=2)
    return rounded(trials)


@query
def tune_regressor(spark, folder):
    train, _ = _parts(spark, folder)
    _, _, trials = T.tune_regressor(train, "LISTING_ID", trials=4, folds=2, space=SHORT_SPACE, startup=2)
    return rounded(trials)


@query
def stacking(spark, folder):
    train, test = _parts(spark, folder)
    stacked = T.fit_stacking(train, "LISTING_ID", {
        "forest": T.zone_pipeline(T.zone_forest(10, 6)),
        "plain": T.zone_pipeline(T.zone_forest(10, 8, weight=None)),
    }, folds=3)
    return rounded(E.evaluate_classifier(stacked.transform(test), T.LABEL, "ZONE_PRED"))


@query
def resample(spark, folder):
    train, _ = _parts(spark, folder)
    balanced = oversample_and_edit(
        train, "LISTING_ID", ["BEDS", "BATH", "LOG_SQFT", "DIST_MANHATTAN_CENTER"], T.LABEL)
    return balanced.groupBy(T.LABEL, "synthetic").agg(F.count("*").alias("n"))


@query
def shapley(spark, folder):
    train, test = _parts(spark, folder)
    forest, _ = _small_models(train)
    values = explain.shapley_values(
        test, "LISTING_ID", ALL_FEATURES, PT.zone_score(forest, 3), max_samples=100, permutations=4)
    return rounded(explain.global_importance(values))


def _explained(spark, folder, model):
    """Mean absolute attribution per feature and output over all test rows, and the largest gap between a row's sum and its outputs."""
    train, test = _parts(spark, folder)
    fitted = model.fit(train)
    values, mean = tree_attributions(test, "LISTING_ID", fitted, ALL_FEATURES, max_samples=None)
    values = stage(values, "attributions")
    sums = values.groupBy("row_id", "output").agg(F.sum("value").alias("total"))
    outputs = tree_outputs(test, "LISTING_ID", fitted).select("row_id", F.posexplode("outputs").alias("output", "reached"))
    base = F.get(F.array(*[F.lit(float(m)) for m in mean]), F.col("output"))
    gap = sums.join(outputs, ["row_id", "output"]).groupBy("output").agg(
        F.max(F.abs(F.col("total") + base - F.col("reached"))).alias("gap"))
    mean_abs = values.groupBy("output", "feature").agg(F.avg(F.abs("value")).alias("mean_abs"))
    return rounded(mean_abs.join(F.broadcast(gap), "output"))  # one row per output


@query
def tree_shapley_booster(spark, folder):
    return _explained(spark, folder, T.zone_pipeline(T.zone_booster(10, 4)))


@query
def tree_shapley_forest(spark, folder):
    return _explained(spark, folder, T.price_pipeline(T.price_forest(20, 6)))


@query
def score_batch(spark, folder):
    train, _ = _parts(spark, folder)
    scored, _ = PS.score_batch(A.requests(spark, folder), *_small_models(train), ["request_id"])
    return scored.select("request_id", "zone.price_zone", "zone.confidence", "price.predicted_price",
                         "price.price_range.low", "price.price_range.high")


# --- files ----------------------------------------------------------------------------------------


def _scratch(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _write_export(df, path, preamble, header):
    """Text files of `df`, each beginning with the preamble and the header."""
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    opening = F.array(*[F.lit(x) for x in (*preamble, header)])
    lines = df.repartition(3).select(line.alias("value"), first.alias("first"))
    lines.select(F.explode(F.when(F.col("first"), F.concat(opening, F.array("value"))).otherwise(F.array("value")))).write.text(path)


def _exports(spark, folder):
    """Three folders of sales exports; a preamble line also reads like a sale, and one header names fewer columns."""
    top, sales = _scratch(spark, "exports"), A.rolling_sales(spark, folder)
    sales = sales.withColumn("SALE_PRICE", F.concat(F.lit('"'), F.trim("SALE_PRICE"), F.lit('"')))
    for kind, rows in enumerate(HEADER_ROW_CANDIDATES):
        preamble = ["Rolling sales", '3,0,"0"', "", "as of today", "all boroughs"][:rows]
        names = ["BOROUGH", "YEAR_BUILT", "SALE_PRICE"] + (["ZIP_CODE"] if kind else [])
        header = "BOROUGH,YEAR BUILT, SALE PRICE " + (",ZIP CODE" if kind else "")
        _write_export(sales.filter(F.pmod("sale_id", F.lit(3)) == kind).select(*names), f"{top}/kind{kind}", preamble, header)
    return [f"{top}/kind{k}" for k in range(3)]


@query
def read_exports(spark, folder):
    read = files.read_exports(spark, _exports(spark, folder))
    return read.select("BOROUGH", F.col("`YEAR BUILT`").alias("year_built"), F.col("`SALE PRICE`").alias("sale_price"),
                       F.col("`ZIP CODE`").alias("zip_code"))


@query
def read_workbooks(spark, folder):
    """Workbooks of at most about 20,000 sales each, of three kinds, made by tasks and read again."""
    sales = A.rolling_sales(spark, folder)
    books = max(1, sales.count() // 60_000)
    spread = sales.select(F.pmod("sale_id", F.lit(3)).cast("int").alias("kind"), F.pmod(F.xxhash64("sale_id"), F.lit(books)).alias("book"),
                          "BOROUGH", "YEAR_BUILT", F.trim("SALE_PRICE").alias("SALE_PRICE"), "ZIP_CODE")

    def book(rows):
        kind = rows.column("kind")[0].as_py()
        preamble = [["Rolling sales"], [3, 0, "0"], [], ["as of today"], ["all boroughs"]][:HEADER_ROW_CANDIDATES[kind]]
        names = ["BOROUGH", "YEAR_BUILT", "SALE_PRICE"] + (["ZIP_CODE"] if kind else [])
        header = ["BOROUGH", "YEAR BUILT", " SALE PRICE "] + (["ZIP CODE"] if kind else [])
        cells = [list(r) for r in zip(*[rows.column(n).to_pylist() for n in names])]
        content = workbooks.workbook_bytes({"sales": [*preamble, header, *cells]})
        return pa.table([pa.array([f"{kind}-{rows.column('book')[0]}"]), pa.array([content])], ["file", "content"])

    made = spread.groupBy("kind", "book").applyInArrow(book, "file string, content binary")
    read = workbooks.concatenated(workbooks.workbook_rows(made))
    return read.select("BOROUGH", F.col("`YEAR BUILT`").alias("year_built"), F.col("`SALE PRICE`").alias("sale_price"),
                       F.col("`ZIP CODE`").alias("zip_code"))


@query
def header_rows(spark, folder):
    found = files.locate_header_rows(spark, _exports(spark, folder))
    return found.select(F.regexp_extract("file", "/kind([0-9])/", 1).cast("int").alias("kind"), "header_row").distinct()


@query
def read_exports_with_line_breaks(spark, folder):
    sales = A.rolling_sales(spark, folder).select("BOROUGH", F.trim("SALE_PRICE").alias("p"), F.col("sale_id").alias("NOTE"))
    rows = sales.select("BOROUGH", F.concat(F.lit('"'), "p", F.lit('"')).alias("p"),
                        F.concat(F.lit('"sale'), F.lit("\n"), F.col("NOTE").cast("string"), F.lit('"')).alias("NOTE"))
    path = _scratch(spark, "broken")
    _write_export(rows, path, ["a", "b", "", "c"], "BOROUGH,SALE PRICE,NOTE")
    read = files.read_exports(spark, [path], multi_line=True)
    return read.select("BOROUGH", F.col("`SALE PRICE`").alias("sale_price"), F.col("NOTE").alias("note"))


@query
def load_raw(spark, folder):
    """Listings written as CSV and read back: types, trimmed names, quoted line breaks, leading zeros."""
    path = _scratch(spark, "listings")
    rows = A.listings(spark, folder).select(
        "listing_id", F.col("PRICE").alias(" price "), "BEDS", "ZIPCODE", F.concat("TYPE", F.lit("\n"), F.lit('a "b"')).alias("TYPE"))
    rows.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return rounded(files.load_raw(spark, path).select("LISTING_ID", "PRICE", "BEDS", "ZIPCODE", "TYPE"), 4)


@query
def metric_log(spark, folder):
    """Metrics and parameters of two runs, appended and read back."""
    path, row = _scratch(spark, "metrics"), E.evaluate_classifier(A.scored(spark, folder), "y_true", "y_pred").first().asDict()
    for run in ("first", "second"):
        files.log_metrics(spark, path, run, "zones", row, {"depth": 6, "kind": run})
    return rounded(files.read_metrics(spark, path))


@query
def firewall_report(spark, folder):
    """The report of a whole run, written and read again; without a model inference is skipped."""
    path = _scratch(spark, "report")
    PF.run_firewall(A.rolling_sales(spark, folder), f"{path}-none", "contract", ["sale_id"], W.UNDERSCORED, report_path=path)
    read = spark.read.schema(PF.as_table(spark, {}).schema).json(path)
    return read.select("n_raw", "n_dropped", "n_scored", F.map_values("drop_reasons").alias("_n"), "contract_sha256",
                       F.col("inference.status").alias("inference"), F.col("leakage.name_based.triggered").alias("leaks_by_name"),
                       "performance.n_scored").toDF(
        "n_raw", "n_dropped", "n_scored", "_n", "contract_sha256", "inference", "leaks_by_name", "n_judged").withColumn(
        "n_reasons", F.aggregate("_n", F.lit(0).cast("long"), lambda a, x: a + x)).drop("_n")


@query
def mapping_invariants(spark, folder):
    raw = A.rolling_sales(spark, folder)
    noise = raw.select("sale_id", "SALE_PRICE").withColumn("sale_id", F.col("sale_id") + 1)
    return guards.check_statelessness(
        lambda df: W.apply_schema_map(df, ["sale_id"], W.UNDERSCORED)[0].drop("TARGET"), raw, "sale_id", "SALE_PRICE", noise)


@query
def schema_difference(spark, folder):
    """What the columns of the orders lack of, and have beyond, those of the line items."""
    orders, items = A.table(spark, folder, "orders"), A.table(spark, folder, "lineitem")
    return guards.schema_difference_table(orders, [c.replace("l_", "o_", 1) for c in items.columns])


# --- streams ------------------------------------------------------------------------------------


def _event_stream(spark, folder):
    schema = A.table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _run_to_table(df, name):
    """Run a stream over everything available and read its sink."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    S2.start_append(df, f"{path}/out", f"{path}/checkpoint", available_now=True).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/out")


@query
def score_stream(spark, folder):
    train, _ = _parts(spark, folder)
    path = f"{shared_dir(spark)}/score-{uuid.uuid4().hex}"
    requests = A.requests_from_events(_event_stream(spark, folder))
    S2.score_stream(requests, *_small_models(train), path, f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/scored").select(
        "request_id", "zone.price_zone", "zone.confidence", "price.predicted_price",
        "price.price_range.low", "price.price_range.high")


@query
def drift_stream(spark, folder):
    old, _ = _events(spark, folder)
    stats = M.feature_stats(old, ["value", "user_id"])
    out = _run_to_table(S2.drift_stream(_event_stream(spark, folder), stats, "ts", ["value", "user_id"]), "drift")
    return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query
def dedup_stream(spark, folder):
    events = _event_stream(spark, folder).selectExpr(
        "ts", "CAST(404000 + user_id * 7 AS DOUBLE) / 10000D AS LATITUDE",
        "CAST(-743000 + user_id * 11 AS DOUBLE) / 10000D AS LONGITUDE", "CAST(user_id * 1000 AS DOUBLE) AS PRICE")
    return _run_to_table(S2.deduplicate_stream(events, "ts", "60 days"), "dedup").drop("ts")
