"""``python -m tarmac`` or ``spark-submit tarmac/__main__.py``: one monthly run, or the landing-folder ingest."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from tarmac.functions import raw_month_path
from tarmac.plans.monthly import register_tables, run_month
from tarmac.streaming import start_ingest


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tarmac", description="On-time performance tables from raw monthly files.")
    source = out.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", help="raw CSV files or zip archives of one delivery")
    source.add_argument("--raw-root", help="root of raw files; the run date's previous month is read from YYYY/MM/ below it")
    source.add_argument("--landing", help="folder to ingest as a stream")
    out.add_argument("--output", required=True, help="root of the tables")
    out.add_argument("--run-date", type=dt.date.fromisoformat, help="the month before it is expected (YYYY-MM-DD)")
    out.add_argument("--as-of", type=dt.date.fromisoformat, help="flights before this date only (default: today)")
    out.add_argument("--archives", action="store_true", help="the input is zip archives")
    out.add_argument("--dedupe", action="store_true", help="keep one row per flight key")
    out.add_argument("--database", help="also register the tables in this database")
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.raw_root and not args.run_date:
        parser().error("--raw-root needs --run-date")
    spark = SparkSession.builder.appName("tarmac").getOrCreate()
    if args.landing:
        start_ingest(
            spark, args.landing, args.output, archives=args.archives, as_of=args.as_of, dedupe_keys=args.dedupe
        ).awaitTermination()
        failed = 0
    else:
        result = run_month(
            spark,
            args.input or raw_month_path(args.raw_root, args.run_date),
            args.output,
            run_date=args.run_date,
            as_of=args.as_of,
            archives=args.archives,
            dedupe_keys=args.dedupe,
        )
        print(f"{result.raw_rows} raw, {result.clean_rows} clean, {result.rejected_rows} rejected rows; months {result.months}")
        print(f"{result.dropped_rows} dropped rows; version {result.version}")
        result.table("clean").printSchema()
        result.preview().show(truncate=False)
        result.checks.show(50, truncate=False)
        failed = result.failed_checks().count()
    if args.database:
        register_tables(spark, args.output, args.database)
    return int(failed > 0)


if __name__ == "__main__":
    raise SystemExit(main())
