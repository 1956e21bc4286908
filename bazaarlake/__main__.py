"""Command line of the daily steps, for spark-submit.

    load             replace the raw tables with the historical exports of a folder
    init-watermarks  set missing watermarks from the raw tables
    ingest           append what is new in the landed pages of each entity
    build            rebuild all models
    check            run the declared checks on what was built
    validate         judge one ingested batch
    day              ingest, build, check, validate
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.operators.quality import run_checks
from bazaarlake.plans.build import build_models, built_models
from bazaarlake.plans.checks import MONITORING, suite, validate_batch
from bazaarlake.plans.daily_run import run_day
from bazaarlake.plans.ingest import init_watermarks, run_batch
from bazaarlake.schemas import ENTITIES, landing_schema
from bazaarlake.session import tune
from bazaarlake.sources.csv_files import csv_catalogue, load_catalogue
from bazaarlake.sources.ingest_log import WatermarkStore
from bazaarlake.sources.landing import read_landing_pages
from bazaarlake.sources.tables import Layers, create_append_tables, create_layers, source


def landed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """One folder of JSON pages per entity."""
    return {e.name: read_landing_pages(spark, f"{folder}/{e.name}", landing_schema(e)) for e in ENTITIES}


def parse(argv: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="bazaarlake", description=__doc__.splitlines()[0])
    names = Layers()
    parser.add_argument("step", choices="load init-watermarks ingest build check validate day".split())
    for layer in ("raw", "staging", "intermediate", "marts"):
        parser.add_argument(f"--{layer}", default=getattr(names, layer), help=f"namespace of the {layer} layer")
    parser.add_argument("--folder", help="exports for load, landed pages for ingest and day")
    parser.add_argument("--prefix", default="", help="file name prefix of the exports")
    parser.add_argument("--suffix", default=".csv", help="file name suffix of the exports")
    parser.add_argument("--batch-id", help="given id of the batch; made up when left out")
    parser.add_argument("--normalize-keys", action="store_true", help="clean keys before versions are compared")
    args = parser.parse_args(argv)
    if args.step in ("load", "ingest", "day") and not args.folder:
        parser.error(f"{args.step} needs --folder")
    if args.step == "validate" and not args.batch_id:
        parser.error("validate needs --batch-id")
    return args


def main(argv: Sequence[str], spark: SparkSession | None = None) -> int:
    args = parse(argv)
    spark = tune(spark or SparkSession.builder.appName("bazaarlake").getOrCreate())
    layers = create_layers(spark, Layers(args.raw, args.staging, args.intermediate, args.marts))
    create_append_tables(spark, layers.raw)
    if args.step == "load":
        items = csv_catalogue(args.folder, args.prefix, args.suffix)
        for table, count in load_catalogue(spark, items, layers.raw).items():
            print(f"{table}: {count} rows")
    elif args.step == "init-watermarks":
        store = WatermarkStore(spark, layers.raw)
        raw = (source(spark, layers.raw, name) for name in ("orders", "reviews"))
        store.save_all([tuple(row) for row in init_watermarks(store.load(), *raw).collect()])
    elif args.step == "ingest":
        print(run_batch(spark, landed(spark, args.folder), layers.raw, args.batch_id))
    elif args.step == "build":
        build_models(spark, layers, args.normalize_keys)
    elif args.step == "check":
        models = built_models(spark, layers)
        bad = run_checks(models, suite()).filter(F.col("status") != "pass").collect()
        for row in bad:
            print(f"{row['status']}: {row['model']}.{row['check_name']}: {row['failures']}")
        return int(any(row["status"] == "fail" for row in bad))
    elif args.step == "validate":
        for line in validate_batch(spark.table(f"`{layers.marts}`.`{MONITORING}`"), args.batch_id):
            print(line)
    else:
        report = run_day(spark, landed(spark, args.folder), layers, args.batch_id, args.normalize_keys)
        print("\n".join([report.batch_id, *report.entities]))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
