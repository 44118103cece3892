"""``python -m siltstone run <lake> [--config file] [--incremental]`` and
``python -m siltstone report <lake> <run id>``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from siltstone.config import DEFAULT_CONFIG, load_config
from siltstone.plans.pipeline import run_pipeline
from siltstone.plans.quality import report
from siltstone.sources.lake import Lake


def main() -> None:
    parser = argparse.ArgumentParser(prog="siltstone")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="load all sources and check the result")
    run.add_argument("lake")
    run.add_argument("--config", default=str(DEFAULT_CONFIG))
    run.add_argument("--incremental", action="store_true")
    show = commands.add_parser("report", help="print the quality report of one run")
    show.add_argument("lake")
    show.add_argument("run_id")
    args = parser.parse_args()

    spark = (
        SparkSession.builder.appName("siltstone")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    lake = Lake(spark, args.lake)
    if args.command == "run":
        done = run_pipeline(lake, load_config(args.config), incremental=args.incremental)
        print(report(lake, done.quality_run_id))
    else:
        print(report(lake, args.run_id))


if __name__ == "__main__":
    main()
