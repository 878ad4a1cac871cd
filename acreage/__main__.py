"""Command line: python -m acreage {clean,train,score,firewall,drift} ..."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from acreage.ml.training import load_model, load_thresholds
from acreage.operators.monitoring import check_drift
from acreage.plans.firewall import run_firewall
from acreage.plans.listings import clean_listings
from acreage.plans.scoring import score_batch
from acreage.plans.training import Effort, run_training
from acreage.schemas import REQUESTS
from acreage.session import build_session, release
from acreage.sources import files

KEY = "LISTING_ID"


def _table(spark: SparkSession, path: str) -> DataFrame:
    return files.load_cleaned(spark, path, KEY) if path.endswith(".csv") else spark.read.parquet(path)


def _clean(spark: SparkSession, args: argparse.Namespace) -> None:
    cleaned = clean_listings(files.load_raw(spark, args.input, KEY), [KEY])
    cleaned.write.mode("overwrite").parquet(args.output)


def _train(spark: SparkSession, args: argparse.Namespace) -> None:
    effort = Effort(
        trees=args.trees, rounds=args.rounds, network=not args.no_network, clusters=args.clusters or None, trials=args.trials,
        explained_rows=args.explained_rows)
    tables = run_training(_table(spark, args.input), args.key, args.models, args.run, effort)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{args.models}/tables/{name}")
        print(name)
        df.show(20, truncate=False)


def _score(spark: SparkSession, args: argparse.Namespace) -> None:
    requests = spark.read.schema(REQUESTS).json(args.requests)
    scored, rejected = score_batch(
        requests, load_model(f"{args.models}/price_zone_best"), load_model(f"{args.models}/price_regressor_best"),
        ["request_id"], load_thresholds(f"{args.models}/price_zone_best"))
    scored.write.mode("overwrite").json(f"{args.output}/scored")
    rejected.write.mode("overwrite").json(f"{args.output}/rejected")


def _firewall(spark: SparkSession, args: argparse.Namespace) -> None:
    with open(args.contract, encoding="utf-8") as f:
        text = f.read()
    result = run_firewall(
        files.read_exports(spark, args.sales), args.model, text, manifest=files.file_manifest(spark, args.sales),
        commit=args.commit, report_path=args.report)
    print(json.dumps(result, indent=2))


def _drift(spark: SparkSession, args: argparse.Namespace) -> None:
    baseline = files.load_baseline(spark, args.baseline)
    check_drift(_table(spark, args.current), baseline, args.threshold, args.fail).show(100, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="acreage")
    commands = top.add_subparsers(dest="command", required=True)

    clean = commands.add_parser("clean", help="clean a listings CSV into Parquet")
    clean.add_argument("--input", required=True)
    clean.add_argument("--output", required=True)
    clean.set_defaults(run_command=_clean)

    train = commands.add_parser("train", help="train on cleaned listings, CSV or Parquet")
    train.add_argument("--input", required=True)
    train.add_argument("--models", required=True)
    train.add_argument("--key", default=KEY)
    train.add_argument("--run", default="run")
    train.add_argument("--trees", type=int, default=Effort.trees)
    train.add_argument("--rounds", type=int, default=Effort.rounds)
    train.add_argument("--clusters", type=int, default=Effort.clusters, help="0 for none")
    train.add_argument("--explained-rows", type=int, default=Effort.explained_rows)
    train.add_argument("--trials", type=int, default=Effort.trials, help="of the parameter search; 0 for none")
    train.add_argument("--no-network", action="store_true")
    train.set_defaults(run_command=_train)

    score = commands.add_parser("score", help="score JSON requests")
    score.add_argument("--requests", required=True)
    score.add_argument("--models", required=True)
    score.add_argument("--output", required=True)
    score.set_defaults(run_command=_score)

    firewall = commands.add_parser("firewall", help="check a model on rolling-sales exports")
    firewall.add_argument("--sales", nargs="+", required=True)
    firewall.add_argument("--model", required=True)
    firewall.add_argument("--contract", required=True)
    firewall.add_argument("--commit")
    firewall.add_argument("--report")
    firewall.set_defaults(run_command=_firewall)

    drift = commands.add_parser("drift", help="compare a table with a saved baseline")
    drift.add_argument("--current", required=True)
    drift.add_argument("--baseline", required=True)
    drift.add_argument("--threshold", type=float, default=0.15)
    drift.add_argument("--fail", action="store_true")
    drift.set_defaults(run_command=_drift)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    args.run_command(spark, args)
    release(spark)


if __name__ == "__main__":
    main()
