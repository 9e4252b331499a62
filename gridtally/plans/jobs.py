"""The jobs: build and store the tables, run the reports, or both."""

import logging
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.functions import times
from gridtally.operators.expand import check_columns, expand_daily_array_to_hourly, rejected_meter_days
from gridtally.plans.incremental import Run, write_all, write_new
from gridtally.plans.pipeline import Options, hourly_partitions
from gridtally.plans.reports import BOUNDED_REPORTS, DAY_REPORTS, REPORTS, Tables, day_reports
from gridtally.settings import (
    DAILY_TABLE,
    HOURLY_TABLE,
    HOURS_PER_DAY,
    MAX_COPIES_PER_TASK,
    MONTHLY_TABLE,
    REJECTS_TABLE,
)
from gridtally.sources import versions
from gridtally.sources.meter_days import read_all_parquets
from gridtally.sources.tables import (
    open_tables,
    register_views,
    save_table,
    table_path,
    write_csv,
)

log = logging.getLogger(__name__)

METRICS = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("n_rows", T.LongType()),
])
STATUS = T.StructType([
    T.StructField("report", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("error", T.StringType()),
])


def run_etl(spark: SparkSession, input_glob: str, out_folder: str | None, table_root: str,
            options: Options = Options(), input_schema: T.StructType | None = None,
            if_exists: str = "replace", save_rejects: bool = False) -> dict[str, DataFrame] | None:
    """Read meter-days, store the tables under ``table_root`` and CSVs under ``out_folder``.

    ``out_folder=None`` leaves the CSVs out, among them the two hourly ones, whose
    rows must be sorted over all meters.  Returns the stored tables and registers
    them as views; None without input.

    ``if_exists`` is ``replace``, ``fail`` or ``append``.  ``append`` takes the input for new meter-days and goes on from the
    stored tables, which become what a run over all input would make; a meter's new days must come after its stored ones
    (LateMeterDays otherwise).  The CSV of raw hours is then one of the new days.

    The tables become current together, when all are written; a run that fails before leaves the earlier ones.
    """
    if if_exists not in ("replace", "fail", "append"):
        raise ValueError("if_exists must be 'replace', 'fail' or 'append'")
    before = versions.current(spark, table_root)
    if if_exists == "fail" and before is not None:
        raise FileExistsError(f"{table_root} holds tables already")
    raw = read_all_parquets(spark, input_glob, input_schema)
    if raw.isEmpty():
        log.error("no input rows in %s", input_glob)
        return None
    check_columns(raw, options.date_col, options.arr_col)

    if out_folder is not None:
        write_hours_csv(raw, table_path(out_folder, "meter_hourly_raw.csv"), options)
    if options.hourly_partitions is None:
        session = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # The number of rows stands in the files' footers.
        options = replace(options, hourly_partitions=hourly_partitions(raw.count(), session))
    # Only the hourly order needs the place of a row; the schema is known by now.
    placed = read_all_parquets(spark, input_glob, input_schema, source_row=True)
    run = Run(spark, table_root, options, before)
    if if_exists == "append" and before is not None:
        counts = write_new(run, placed)
    else:
        counts = write_all(run, raw, placed)
    if save_rejects:
        save_table(rejected_meter_days(raw, options.date_col, options.arr_col), REJECTS_TABLE, table_root,
                   "append" if if_exists == "append" else "replace")
    run.publish()

    tables = open_tables(spark, table_root)
    register_views(tables)
    if out_folder is not None:
        write_csv(tables[HOURLY_TABLE], table_path(out_folder, "meter_hourly_features.csv"),
                  order_by=["ext_dev_ref", "timestamp", "timestamp_local"])
        write_csv(tables[DAILY_TABLE], table_path(out_folder, "meter_daily_agg.csv"),
                  order_by=["client_id", "ext_dev_ref", "date_local"])
        write_csv(tables[MONTHLY_TABLE], table_path(out_folder, "meter_monthly_agg.csv"),
                  order_by=["client_id", "ext_dev_ref", "year", "month"])
    save_run_metrics(spark, counts, run.rows, table_root)
    return tables


def save_run_metrics(spark: SparkSession, counts: dict[str, int], written: dict[str, int], table_root: str) -> None:
    """Append the run's row counts to the table ``run_metrics``; what was written is counted as it is stored."""
    rows = [
        ("meter_days_read", counts["read"]),
        ("meter_days_rejected", counts["rejected"]),
        ("meter_days_unparsed", counts["unparsed"]),
        ("hours_expanded", (counts["read"] - counts["rejected"]) * HOURS_PER_DAY),
        *((f"{name}_written", written[name]) for name in (HOURLY_TABLE, DAILY_TABLE, MONTHLY_TABLE)),
    ]
    for step, n_rows in rows:
        log.info("%s: %d", step, n_rows)
    metrics = spark.createDataFrame(rows, METRICS).withColumn("logged_at", F.current_timestamp())
    save_table(metrics.coalesce(1), "run_metrics", table_root, if_exists="append")


def write_hours_csv(raw: DataFrame, path: str, options: Options = Options()) -> None:
    """The hours of all meter-days as CSV, sorted by meter and local time over all files.

    The meter-days are dealt out by ranges of meter and date before they are expanded, so that one shuffle of arrays does;
    each file is sorted after the expansion.  A date of a meter with very many copies is dealt out hour by hour.
    """
    day = times.to_day(raw, options.date_col)
    crowded = (raw.groupBy(F.col("ext_dev_ref").alias("_meter"), day.alias("_day")).agg(F.count("*").alias("_n"))
               .where(F.col("_n") > MAX_COPIES_PER_TASK).select("_meter", "_day"))
    days = raw.withColumns({"_at": day, "_hour": F.lit(None).cast("int"), "_tie": F.lit(0).cast("bigint")})
    if not crowded.isEmpty():
        same = F.col("ext_dev_ref").eqNullSafe(F.col("_meter")) & F.col("_at").eqNullSafe(F.col("_day"))
        every_hour = F.explode(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1)))
        split = days.join(crowded, same, "left_semi").withColumn("_hour", every_hour).withColumn("_tie", F.monotonically_increasing_id())
        days = days.join(crowded, same, "left_anti").unionByName(split.select(*days.columns))
    n = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = days.repartitionByRange(n, "ext_dev_ref", "_at", "_hour", "_tie")
    hours = expand_daily_array_to_hourly(dealt, options.date_col, options.arr_col, options.timezone, keep=["_hour"])
    own = hours.where("_hour IS NULL OR _hour = hour").drop("_hour")
    write_csv(own.sortWithinPartitions("ext_dev_ref", "timestamp_local"), path)


def run_queries(spark: SparkSession, tables: Tables, out_folder: str, reports=None, bounded=BOUNDED_REPORTS) -> DataFrame:
    """Write every report as CSV; one that fails is logged and the others go on.

    The reports that only count and sum days by a few values are taken from one pass over the daily table; if that pass fails, each is run by itself.
    The reports named in ``bounded`` don't grow with the data and become one file each.
    Returns a row per report with its state and number of rows.
    """
    reports = dict(REPORTS if reports is None else reports)
    shared = [name for name, report in reports.items() if name in DAY_REPORTS and report is REPORTS[name]]
    if len(shared) > 1:
        try:
            reports |= day_reports(tables, shared)
        except Exception:  # noqa: BLE001 - each report shows its own failure below
            log.exception("the common pass of %s failed", ", ".join(shared))
    status = []
    for name, report in reports.items():
        path = table_path(out_folder, f"{name}.csv")
        try:
            rows = Observation()
            write_csv(report(tables).observe(rows, F.count(F.lit(1)).alias("n")), path, single_file=name in bounded)
            n = rows.get["n"]
            status.append((name, "ok", n, None))
            log.info("report %s: %d rows", name, n)
        except Exception as error:  # noqa: BLE001 - any failure belongs in the status
            log.exception("report %s failed", name)
            status.append((name, "failed", None, (str(error).splitlines() or [type(error).__name__])[0]))
    return spark.createDataFrame(status, STATUS)


def main(spark: SparkSession, input_glob: str, out_folder: str, table_root: str,
         report_folder: str, options: Options = Options(), **etl) -> DataFrame | None:
    """Build the tables, then run the reports over them; None without input."""
    tables = run_etl(spark, input_glob, out_folder, table_root, options, **etl)
    if tables is None:
        return None
    return run_queries(spark, tables, report_folder)
