"""Command line: ``spark-submit -m gridtally`` or ``python -m gridtally``."""

import argparse
import logging

from pyspark.sql import SparkSession

from gridtally.plans.incremental import LateMeterDays
from gridtally.plans.jobs import run_etl, run_queries
from gridtally.plans.pipeline import Options
from gridtally.schemas import METER_DAYS
from gridtally.settings import LOCAL_TZNAME
from gridtally.sources.tables import table_path
from gridtally.sources.versions import ConcurrentRun


def _arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gridtally", description=__doc__)
    parser.add_argument("--input-glob", default="data/*.parquet", help="parquet files of meter-days (default: %(default)s)")
    parser.add_argument("--out-folder", default="outputs", help="folder for CSV files and reports (default: %(default)s)")
    parser.add_argument("--table-root", default="tables", help="folder of the stored tables (default: %(default)s)")
    parser.add_argument("--timezone", default=LOCAL_TZNAME, help="zone of the meters")
    parser.add_argument("--calendar", choices=("utc", "local"), default="utc",
                        help="wall time that hours and dates are taken from")
    parser.add_argument("--declared-schema", action="store_true",
                        help="read with the declared schema instead of merging all footers")
    parser.add_argument("--lags", type=int, nargs="*", default=list(Options.lags), metavar="ROWS", help="lags of the hourly table")
    parser.add_argument("--window-hours", type=int, default=Options.window_hours, help="rows of the hourly rolling window")
    parser.add_argument("--rolling-days", type=int, nargs="*", default=list(Options.rolling_days), metavar="DAYS",
                        help="rows of the daily rolling means")
    parser.add_argument("--bins", type=float, nargs="*", default=list(Options.bins), metavar="KWH", help="edges of the bands")
    parser.add_argument("--labels", nargs="*", default=list(Options.labels), metavar="NAME", help="names of the bands")
    parser.add_argument("--hourly-partitions", type=int, help="partitions of the hourly table (default: by the input)")
    parser.add_argument("--if-exists", choices=("replace", "append", "fail"), default="replace",
                        help="what to do with stored tables; append takes the input for new meter-days")
    parser.add_argument("--no-table-csv", action="store_true", help="write no CSV of the tables")
    parser.add_argument("--save-rejects", action="store_true", help="store the rejected meter-days")
    parser.add_argument("--no-reports", action="store_true", help="build the tables only")
    return parser.parse_args(argv)


def run(argv=None) -> int:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(name)s: %(message)s")
    spark = SparkSession.builder.appName("gridtally").getOrCreate()
    try:
        tables = run_etl(
            spark, args.input_glob, None if args.no_table_csv else args.out_folder, args.table_root,
            Options(timezone=args.timezone, calendar=args.calendar, lags=tuple(args.lags), window_hours=args.window_hours,
                    rolling_days=tuple(args.rolling_days), bins=tuple(args.bins), labels=tuple(args.labels),
                    hourly_partitions=args.hourly_partitions),
            if_exists=args.if_exists,
            input_schema=METER_DAYS if args.declared_schema else None,
            save_rejects=args.save_rejects,
        )
    except (FileExistsError, LateMeterDays, ConcurrentRun) as error:
        logging.error("%s", error)
        return 1
    if tables is None:
        return 1
    if not args.no_reports:
        status = run_queries(spark, tables, table_path(args.out_folder, "reports"))
        status.show(truncate=False)
        return 1 if status.where("status <> 'ok'").count() else 0
    return 0


if __name__ == "__main__":
    raise SystemExit(run())
