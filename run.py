"""Run the batch on CSV extracts.

spark-submit run.py --users U --transactions T --onboarding O --output FOLDER
    [--stage all|explore|preprocess|transform|serve] [--skip-exploration]
    [--rejects] [--parallel-csv] [--keyspace NAME] [--with-week] [--wide-counts] [--date-from D] [--date-to D]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from firstmile import Rules
from firstmile.plans import batch
from firstmile.plans.explore import explore
from firstmile.plans.publish import status_table
from firstmile.schemas import Contract
from firstmile.sources import keyed_table, read_parquet, versioned_table, write_parquet

STAGES = ("explore", "preprocess", "transform", "serve")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--users", help="CSV file or folder")
    parser.add_argument("--transactions", help="CSV file or folder")
    parser.add_argument("--onboarding", help="CSV file or folder")
    parser.add_argument("--output", required=True, help="folder that all executors share")
    parser.add_argument("--stage", choices=("all", *STAGES), default="all")
    parser.add_argument("--skip-exploration", action="store_true")
    parser.add_argument("--rejects", action="store_true", help="keep removed rows, and count records of another width")
    parser.add_argument("--parallel-csv", action="store_true", help="read the users file by many tasks")
    parser.add_argument("--keyspace", help="publish to this keyspace instead of Parquet")
    parser.add_argument("--with-week", action="store_true", help="add weeks to the funnel")
    parser.add_argument("--wide-counts", action="store_true", help="BIGINT instead of INT")
    parser.add_argument("--date-from", default=Rules.date_from)
    parser.add_argument("--date-to", default=Rules.date_to)
    args = parser.parse_args()

    spark = SparkSession.builder.getOrCreate()
    rules = Rules(date_from=args.date_from, date_to=args.date_to)
    stages = set(STAGES) if args.stage == "all" else {args.stage}
    if args.skip_exploration:
        stages.discard("explore")

    if stages & {"explore", "preprocess"}:
        if not (args.users and args.transactions and args.onboarding):
            parser.error("this stage needs --users, --transactions and --onboarding")
        raw = batch.read_extracts(
            spark, args.users, args.transactions, args.onboarding, args.parallel_csv, args.rejects
        )
    if "explore" in stages:
        raw = batch.land_raw(raw, args.output)
        for name, report in explore(raw, rules).items():
            write_parquet(report, f"{args.output}/exploration/{name}")
    if "preprocess" in stages:
        ledger, overlaps = batch.clean_and_compare(raw, rules, args.output, args.rejects)
        ledger.show(truncate=False)
        overlaps.show(truncate=False)
        read_parquet(spark, f"{args.output}/coverage").show(truncate=False)
    if "transform" in stages:
        batch.transform(batch.read_clean(spark, args.output), rules, args.output)
    if "serve" in stages:

        def sink_of(table: str):
            if args.keyspace:
                return keyed_table(table, args.keyspace)
            return versioned_table(f"{args.output}/served/{table}")

        def adapt(contract: Contract) -> Contract:
            if args.keyspace:
                contract = contract.with_instants()
            return contract.with_wide_counts() if args.wide_counts else contract

        published, problems = batch.serve_and_check(
            spark, args.output, sink_of, args.with_week, adapt
        )
        status_table(spark, published).show(truncate=False)
        if problems:
            raise SystemExit("\n".join(problems))


if __name__ == "__main__":
    main()
