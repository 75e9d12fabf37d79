"""Command line: python -m quern ingest|sample|validate|compare|tokenize."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans import pipelines
from .sources import records, sinks
from .sources.run_log import RunLog


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quern")
    parser.add_argument("--settings", help="JSON or YAML")
    steps = parser.add_subparsers(dest="step", required=True)
    step = steps.add_parser("ingest", help="records to split, sharded exports with a manifest")
    step.add_argument("--dataset", help="JSON lines or Parquet with id and text")
    step.add_argument("--pages", help="saved API answers")
    step.add_argument("--exclude-section", action="append", default=[])
    step.add_argument("--out", required=True)
    step.add_argument("--log", help="folder of the log of events")
    step.add_argument("--dry-run", action="store_true")
    step = steps.add_parser("sample", help="a tokenizer sample")
    step.add_argument("--source", required=True)
    step.add_argument("--out", required=True)
    step = steps.add_parser("validate", help="a tokenizer's report")
    step.add_argument("--tokenizer", required=True)
    step.add_argument("--name", required=True)
    step.add_argument("--sentences", required=True)
    step.add_argument("--out", required=True)
    step = steps.add_parser("compare", help="the recommended tokenizer")
    step.add_argument("reports", nargs="+")
    step = steps.add_parser("tokenize", help="packed token sequences")
    step.add_argument("--source", required=True)
    step.add_argument("--tokenizer", required=True)
    step.add_argument("--end-id", type=int, required=True)
    step.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    settings = pipelines.load(args.settings) if args.settings else pipelines.Settings()
    if getattr(args, "dry_run", False):
        print(settings)
        return 0
    spark = SparkSession.builder.appName("quern").getOrCreate()
    if args.step == "ingest":
        dataset = pages = None
        if args.dataset:
            dataset = spark.read.parquet(args.dataset) if args.dataset.rstrip("/").endswith(".parquet") else spark.read.schema("id string, text string").json(args.dataset)
        if args.pages:
            found = records.fetched_pages(spark, args.pages).selectExpr("title", "CAST(NULL AS STRING) AS url", "extract")
            pages = records.paragraph_records(found, args.exclude_section, "wiki", run_id=settings.run_id)
        pipelines.ingest(spark, settings, args.out, dataset, pages, RunLog(spark, args.log, settings.run_id)).show()
    elif args.step == "sample":
        pipelines.sample_texts(spark, settings, args.source, args.out).show()
    elif args.step == "validate":
        sinks.json_report(pipelines.validate(spark, settings, args.tokenizer, args.name, records.sentences(spark, args.sentences)), args.out)
    elif args.step == "compare":
        rows = []
        for path in args.reports:
            with open(path, encoding="utf-8") as f:
                rows.append(json.load(f))
        print(pipelines.compare(spark, rows)[1])
    else:
        pipelines.tokenize(spark, settings, args.source, args.tokenizer, args.out, args.end_id).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
