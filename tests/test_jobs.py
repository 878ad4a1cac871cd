import hashlib
import json

import pytest
from pyspark.sql import functions as F

from acreage.constants import PRICE_ZONES
from acreage.ml import training as T
from acreage.operators import cleaning as C, guards as G, monitoring as M
from acreage.operators.firewall import apply_schema_map
from acreage.plans import firewall, scoring, training as PT
from acreage.sources import adapters as A, files
from acreage.streaming import jobs

FOLDER = "/root/testdata/sf0.001"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_load_raw(spark, tmp_path):
    path = write(tmp_path / "a.csv", " price ,Beds,Zipcode,Address\n100,2,00730,\"1, Main St\"\nx,,10022.0,b\n")
    rows = files.load_raw(spark, path).collect()
    assert rows[0].asDict() == {"PRICE": 100.0, "BEDS": 2.0, "ZIPCODE": "00730", "ADDRESS": "1, Main St"}
    assert rows[1]["PRICE"] is None
    assert [r["ZIPCODE"] for r in files.load_cleaned(spark, path).collect()] == ["00730", "10022"]
    assert files.load_geocode(spark, path).count() == 2
    with pytest.raises(Exception):
        files.load_raw(spark, str(tmp_path / "missing.csv")).count()


def test_positions_order_a_file(spark, tmp_path):
    body = "PRICE,LATITUDE,LONGITUDE,ADDRESS\n" + "".join(f"5,40.5,-74.0,row {i}\n" for i in range(50))
    df = files.load_raw(spark, write(tmp_path / "p.csv", body), position="place")
    assert [r["ADDRESS"] for r in C.deduplicate(df, ["place"]).collect()] == ["row 0"]
    assert [r["ADDRESS"] for r in df.orderBy("place").collect()] == [f"row {i}" for i in range(50)]


HEADER = "BOROUGH,SALE PRICE ,YEAR BUILT"


def test_exports_with_preamble(spark, tmp_path):
    a = write(tmp_path / "a.csv", "x\ny\nz\n\n" + HEADER + "\n1,\"1,000\",1950\n2,5,\n")
    b = write(tmp_path / "b.csv", "x\ny\nz\nBOROUGH,SALE PRICE\r\n3,7\r\n")
    found = {r["file"][-5:]: r["header_row"] for r in files.locate_header_rows(spark, [a, b]).collect()}
    assert found == {"a.csv": 4, "b.csv": 3}
    rows = sorted(tuple(r) for r in files.read_exports(spark, [a, b]).select("BOROUGH", "SALE PRICE", "YEAR BUILT")
                  .fillna("-").collect())
    assert rows == [("1", "1,000", "1950"), ("2", "5", "-"), ("3", "7", "-")]
    bad = write(tmp_path / "c.csv", "a\nb\nc\nd\ne\nf\n")
    with pytest.raises(ValueError, match="c.csv"):
        files.read_exports(spark, [a, bad])


def test_preambles_go_by_place_and_not_by_text(spark, tmp_path):
    row = "1,500000,1920"
    a = write(tmp_path / "a.csv", f"title\n{row}\n\n{HEADER}\n{row}\n2,600000,\n{row}\n,,\n")
    b = write(tmp_path / "b.csv", f"t\nu\nv\nw\n{HEADER}\n{row}\n")
    got = sorted(tuple(r) for r in files.read_exports(spark, [a, b]).fillna("-").collect())
    assert got == [("-", "-", "-")] + [("1", "500000", "1920")] * 3 + [("2", "600000", "-")]


def test_quoted_line_breaks(spark, tmp_path):
    a = write(tmp_path / "a.csv", 't\nu\n\nSALE PRICE,NOTE\n1,"two\nlines"\n2,plain\n')
    assert sorted(tuple(r) for r in files.read_exports(spark, [a], multi_line=True).collect()) == [("1", "two\nlines"), ("2", "plain")]
    b = write(tmp_path / "b.csv", 'PRICE,NOTE\n1,"two\nlines"\n')
    assert [tuple(r) for r in files.load_raw(spark, b).collect()] == [(1.0, "two\nlines")]


def test_manifest(spark, tmp_path):
    path = write(tmp_path / "m.bin", "hello")
    row = files.file_manifest(spark, path).first()
    assert (row["name"], row["bytes"]) == ("m.bin", 5)
    assert row["sha256"] == hashlib.sha256(b"hello").hexdigest()


def test_metric_log_appends(spark, tmp_path):
    for run in ("r1", "r2"):
        files.log_metrics(spark, str(tmp_path / "log"), run, "m", {"f1": 0.5, "none": None})
    assert files.read_metrics(spark, str(tmp_path / "log")).count() == 2


def test_firewall_run(spark, sales, make_listings, tmp_path):
    rows = PT.training_table(make_listings(200), "LISTING_ID", clusters=None)
    model = str(tmp_path / "model")
    T.save_model(T.price_pipeline(T.price_line()).fit(rows), model)
    result = firewall.run_firewall(sales, model, "text", ["sale_id"], report_path=str(tmp_path / "report"))
    assert result["n_scored"] == 15 and result["inference"]["status"] == "failed"
    assert len(result["inference"]["missing_features"]) == 15
    assert result["health_checks"]["status"] == "skipped" and not result["leakage_tripwire"]["triggered"]
    assert not result["leakage"]["semantic"]["triggered"]
    saved = spark.read.json(str(tmp_path / "report")).first()
    assert saved["drop_reasons"]["non_residential_class"] == 4
    assert json.loads(json.dumps(result))["contract_sha256"] == hashlib.sha256(b"text").hexdigest()


def test_firewall_run_with_a_fitting_model(spark, sales, tmp_path):
    mapped, _ = apply_schema_map(sales, [])
    model = T.build_pipeline(
        T.price_line().setLabelCol("TARGET"), "TARGET", T.PRICE, numeric=firewall.NUMERIC_MAPPED,
        onehot=["borough_name"], encoded=[]).fit(mapped)
    T.save_model(model, str(tmp_path / "model"))
    result = firewall.run_firewall(sales, str(tmp_path / "model"), "text")
    assert result["inference"]["status"] == "succeeded" and result["performance"]["n_scored"] == 15
    assert result["health_checks"] == {"status": "failed", "message": result["health_checks"]["message"]}
    assert "insufficient" in result["health_checks"]["message"]


def test_training_job(spark, make_listings, tmp_path):
    effort = PT.Effort(trees=6, forest_depth=5, rounds=2, booster_depth=3, booster_leaves=4, clusters=None, network=False,
                       explained_rows=10, permutations=2)
    out = PT.run_training(make_listings(300), "listing_id", str(tmp_path), effort=effort)
    assert out["classifiers"].count() == 5 and out["regressors"].count() == 4
    assert [r["label"] for r in out["thresholds"].orderBy("position").collect()] == PRICE_ZONES
    assert out["importance"].count() == 15 and out["baseline"].count() == 10
    assert files.read_metrics(spark, str(tmp_path / "metrics")).select("model").distinct().count() == 9
    requests = A.requests(spark, FOLDER)
    scored, rejected = scoring.score_batch(
        requests, T.load_model(str(tmp_path / "price_zone_best")), T.load_model(str(tmp_path / "price_regressor_best")),
        ["request_id"])
    assert scored.count() + rejected.count() == requests.count()
    assert scored.filter("price.price_range.low > price.price_range.high").count() == 0


def event_stream(spark):
    schema = A.table(spark, FOLDER, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(FOLDER).withColumn(
        "ts", F.col("ts").cast("timestamp"))


def test_stream_scores_equal_batch_scores(spark, make_listings, tmp_path):
    rows = PT.training_table(make_listings(200), "LISTING_ID", clusters=None)
    models = (T.zone_pipeline(T.zone_booster(2, 3)).fit(rows), T.price_pipeline(T.price_line()).fit(rows))
    running = jobs.score_stream(
        A.requests_from_events(event_stream(spark)), *models, str(tmp_path), str(tmp_path / "c"), available_now=True)
    running.awaitTermination()
    batch = A.requests(spark, FOLDER).withColumn("ts", F.col("ts").cast("timestamp"))
    scored, rejected = scoring.score_batch(batch, *models, ["request_id", "ts"])
    flat = ["request_id", "ts", "zone.price_zone", "zone.confidence", "price.predicted_price"]
    assert G.same_rows(spark.read.parquet(str(tmp_path / "scored")).select(*flat), scored.select(*flat))
    read = {kind: spark.read.parquet(str(tmp_path / kind)).drop("batch") for kind in ("scored", "rejected")}
    assert G.same_rows(read["rejected"], rejected)
    # the source was read once for both kinds, and a batch that runs again changes nothing
    assert sum(p["numInputRows"] for p in running.recentProgress) == batch.count()
    before = {kind: rows.count() for kind, rows in read.items()}
    folder = next(p for p in (tmp_path / "scored").iterdir() if p.name.startswith("batch="))
    jobs.scoring_sink(*models, str(tmp_path))(batch, int(folder.name.removeprefix("batch=")))
    assert {kind: spark.read.parquet(str(tmp_path / kind)).count() for kind in before} == before


def test_stream_dedup_equals_batch_dedup(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i % 60:02d}:00", 40.5 + (i % 7) / 10000, -74.0, float(i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "listing_id long, ts string, LATITUDE double, LONGITUDE double, PRICE double")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    jobs.start_append(jobs.deduplicate_stream(stream, "ts"), str(tmp_path / "out"), str(tmp_path / "c"), True).awaitTermination()
    key = [c.alias(f"k{i}") for i, c in enumerate(C.near_duplicate_key())]
    got, want = spark.read.parquet(str(tmp_path / "out")), C.deduplicate(df, ["listing_id"])
    assert got.count() == 21 and G.same_rows(got.select(*key), want.select(*key))


def test_stream_drift_equals_batch_drift(spark, tmp_path):
    events = A.table(spark, FOLDER, "events")
    base = M.feature_stats(events, ["value", "user_id"])
    stream = jobs.drift_stream(event_stream(spark), base, "ts", ["value", "user_id"])
    jobs.start_append(stream, str(tmp_path / "out"), str(tmp_path / "c"), True).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    last = got.agg(F.max("window_start")).first()[0]
    want = M.windowed_drift(events.withColumn("ts", F.col("ts").cast("timestamp")), base, "ts", ["value", "user_id"])
    want = want.filter(F.col("window_start") <= F.lit(last))
    same = [F.round(c, 9).alias(c) if c in ("current_mean", "shift") else F.col(c) for c in got.columns]
    assert G.same_rows(got.select(*same), want.select(*same)) and got.count() >= 50


def test_command_line(spark, make_listings, tmp_path, capsys):
    from acreage.__main__ import main

    make_listings(250).drop("listing_id").toPandas().to_csv(tmp_path / "raw.csv", index=False)
    main(["clean", "--input", str(tmp_path / "raw.csv"), "--output", str(tmp_path / "clean")])
    main(["train", "--input", str(tmp_path / "clean"), "--models", str(tmp_path / "models"),
          "--trees", "3", "--rounds", "1", "--clusters", "0", "--explained-rows", "5", "--no-network"])
    row = {"request_id": 1, "beds": 2, "bath": 2.0, "propertysqft": 1200.0, "borough": "manhattan", "type": "condo",
           "zipcode": "10022", "latitude": 40.758, "longitude": -73.985}
    write(tmp_path / "requests.json", json.dumps(row) + "\n" + json.dumps({**row, "request_id": 2, "zipcode": "abc"}))
    main(["score", "--requests", str(tmp_path / "requests.json"), "--models", str(tmp_path / "models"),
          "--output", str(tmp_path / "out")])
    assert spark.read.json(str(tmp_path / "out/scored")).first()["zone"]["price_zone"] in PRICE_ZONES
    assert spark.read.json(str(tmp_path / "out/rejected")).first()["rejected"] == ["zipcode"]
    main(["drift", "--current", str(tmp_path / "clean"), "--baseline", str(tmp_path / "models/drift_baseline")])
    sales = write(tmp_path / "sales.csv", "a\nb\nc\nd\nBOROUGH,BUILDING CLASS CATEGORY,GROSS SQUARE FEET,LAND SQUARE FEET,"
                  "YEAR BUILT,ZIP CODE,SALE PRICE\n1,R4 CONDO,\"1,000\",900,1950,10001,\"500,000\"\n2,01 HOUSE,1,1,1,1,5\n")
    capsys.readouterr()
    main(["firewall", "--sales", sales, "--model", str(tmp_path / "models/price_regressor_best"),
          "--contract", write(tmp_path / "contract.md", "v1")])
    result = json.loads(capsys.readouterr().out)
    assert (result["n_raw"], result["n_scored"]) == (2, 1) and result["inference"]["status"] == "failed"
