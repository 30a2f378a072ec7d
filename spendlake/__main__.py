"""Command line: land the exports, build the models, tidy their files, run the checks, show a report.

    python -m spendlake land  --source exports/ --base /shared/lake [--daily]
    python -m spendlake build --base /shared/lake [--incremental] [--tag finops]
    python -m spendlake recluster --base /shared/lake
    python -m spendlake check --base /shared/lake
    python -m spendlake report top_cost_drivers --month 2024-05-01 --base /shared/lake
"""

from __future__ import annotations

import argparse
import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.plans.pipeline import Pipeline
from spendlake.plans.reports import REPORTS
from spendlake.settings import Settings, prepare_session
from spendlake.sinks.tables import Warehouse
from spendlake.sources.daily_landing import land_days
from spendlake.sources.landing import land, path_exists
from spendlake.sources.schemas import LANDING_SCHEMAS


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="spendlake", description=__doc__)
    parser.add_argument("command", choices=["land", "build", "recluster", "check", "report"])
    parser.add_argument("name", nargs="?", choices=sorted(REPORTS), help="which report")
    parser.add_argument("--base", required=True, help="folder all executors share")
    parser.add_argument("--source", help="folder with <table>.json or <table>.ndjson exports")
    parser.add_argument("--database", default="spendlake")
    parser.add_argument("--landing-database", default="landing")
    parser.add_argument("--daily", action="store_true", help="land usage by day, other days stay")
    parser.add_argument("--split-arrays", action="store_true", help="cut array files by many tasks")
    parser.add_argument("--incremental", action="store_true")
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument("--lookback-days", type=int, default=3)
    parser.add_argument("--currency", default="USD")
    parser.add_argument("--as-of", type=date.fromisoformat)
    parser.add_argument("--tag", action="append", default=[])
    parser.add_argument("--model", action="append", default=[])
    parser.add_argument("--usage-id")
    parser.add_argument("--month", type=date.fromisoformat)
    return parser.parse_args()


#: The landing table that may be kept by day, and below the base path the database it is in.
DAILY, DAILY_DATABASE = "cloud_usage", "landing_days"


def _daily(spark: SparkSession, base: str) -> Warehouse:
    return Warehouse(spark, Settings(database=DAILY_DATABASE, base_path=base))


def _landed(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    landed = {
        name: spark.read.schema(schema).parquet(f"{base}/landing/{name}")
        for name, schema in LANDING_SCHEMAS.items()
        if path_exists(spark, f"{base}/landing/{name}")
    }
    daily = _daily(spark, base)
    return landed | ({DAILY: daily.read(DAILY)} if daily.exists(DAILY) else {})


def _land(spark: SparkSession, source: str, base: str, by_day: bool, array: str) -> None:
    for name, schema in LANDING_SCHEMAS.items():
        ndjson = f"{source}/{name}.ndjson"
        lines = path_exists(spark, ndjson)
        if by_day and name == DAILY:
            file = ndjson if lines else f"{source}/{name}.json"
            kind = "ndjson" if lines else array
            days = land_days(_daily(spark, base), name, file, schema, layout=kind)
            print(f"{name}: skipped, no file" if days is None else f"{name}: {len(days)} days")
            continue
        rows = land(
            spark,
            ndjson if lines else f"{source}/{name}.json",
            f"{base}/landing/{name}",
            schema,
            layout="ndjson" if lines else array,
        )
        print(f"{name}: skipped, no file" if rows is None else f"{name}: {rows} rows")


def main() -> int:
    logging.basicConfig(level=logging.INFO)
    args = _arguments()
    spark = prepare_session(SparkSession.builder.appName("spendlake").getOrCreate())
    if args.command == "land":
        array = "split_array" if args.split_arrays else "array"
        _land(spark, args.source, args.base, args.daily, array)
        return 0
    settings = Settings(
        reporting_currency=args.currency,
        lookback_days=args.lookback_days,
        full_refresh=args.full_refresh,
        incremental=args.incremental,
        as_of=args.as_of,
        database=args.database,
        landing_database=args.landing_database,
        base_path=args.base,
    )
    pipeline = Pipeline(spark, _landed(spark, args.base), settings)
    if args.command == "build":
        for name in pipeline.build(set(args.tag), set(args.model)):
            print(f"built {name}")
        return 0
    if args.command == "recluster":
        for name, partitions in pipeline.recluster().items():
            print(f"reclustered {len(partitions)} partitions of {name}")
        return 0
    if args.command == "report":
        pipeline.report(args.name, usage_id=args.usage_id, month=args.month).show(100, False)
        return 0
    outcome = pipeline.check()
    failed = outcome.where(F.col("failing_rows") > 0).orderBy("model", "column_name").collect()
    for row in failed:
        print(f"FAILED {row.model}.{row.column_name} {row.check_kind}: {row.failing_rows}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
