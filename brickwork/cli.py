"""Command line: run the pipeline, ingest a stream, retrain, predict, check the tables, write the audit."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from brickwork import logs
from brickwork.config import EngineConfig, ModelConfig
from brickwork.operators import audit, model
from brickwork.plans import pipeline
from brickwork.schemas import TRAINING
from brickwork.sources import tables

REQUEST = "property_type string, city string, neighbourhood string, rooms double, baths double, area_m2 double"


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="brickwork", description=__doc__)
    parser.add_argument("--log-level", default="INFO")
    parser.add_argument("--log-style", choices=("json", "text"), default="json")
    todo = parser.add_subparsers(dest="command", required=True)
    run = todo.add_parser("run", help="one run over the raw files that no run has taken")
    run.add_argument("root")
    run.add_argument("raw")
    run.add_argument("--archive", default="")
    run.add_argument("--url-template", default="")
    again = todo.add_parser("retrain", help="train on the feature store, or on a CSV, and save the model")
    again.add_argument("root")
    again.add_argument("models")
    again.add_argument("--csv")
    again.add_argument("--model", choices=ModelConfig().models)
    again.add_argument("--skip-holdout", action="store_true")
    ask = todo.add_parser("predict", help="prices for a CSV of requests with the newest model")
    ask.add_argument("models")
    ask.add_argument("requests")
    ask.add_argument("out")
    todo.add_parser("check", help="whether each table is there and has its schema").add_argument("root")
    report = todo.add_parser("audit", help="the top merged properties and their listings as CSV")
    report.add_argument("root")
    report.add_argument("out")
    report.add_argument("--top", type=int, default=10)
    return parser


def main(args: list[str] | None = None) -> int:
    asked = _parser().parse_args(args)
    logs.configure(asked.log_level, asked.log_style)
    spark = SparkSession.builder.getOrCreate()
    if asked.command == "run":
        print(pipeline.run_pipeline(spark, EngineConfig(root=asked.root, archive=asked.archive, url_template=asked.url_template), asked.raw))
    elif asked.command == "retrain":
        rows = tables.read_csv(spark, asked.csv, TRAINING) if asked.csv else tables.Store(spark, asked.root).read("property_features")
        fitted, folder = model.retrain(rows, asked.models, kind=asked.model, holdout=not asked.skip_holdout)
        print(json.dumps({"model": fitted.kind, "folder": folder, "metrics": fitted.metrics}))
    elif asked.command == "predict":
        model.current(spark, asked.models).predict(tables.read_csv(spark, asked.requests, REQUEST)).write.mode("overwrite").option("header", True).csv(asked.out)
    elif asked.command == "check":
        found = tables.Store(spark, asked.root).check()
        print(json.dumps(found))
        return int(any(x.startswith("differs") for x in found.values()))
    else:
        store = tables.Store(spark, asked.root)
        audit.write_merged(store.read("listings"), store.read("properties"), store.read("locations"), asked.out, asked.top)
    return 0


if __name__ == "__main__":
    sys.exit(main())
