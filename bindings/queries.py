"""Queries over the test tables, one per group of operators."""

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindings.testdata import BINS, meter_raw
from gridtally.operators import daily as d
from gridtally.operators.expand import expand_daily_array_to_hourly, rejected_meter_days
from gridtally.operators.hourly import add_time_features_hourly, unparsed_timestamps
from gridtally.operators.lookback import (
    Lookback,
    add_lag_features,
    add_lookback_features,
    add_rolling_features_hourly,
)
from gridtally.operators.monthly import derive_monthly_from_daily
from gridtally.operators.similarity import add_daily_load_shape_similarity
from gridtally.plans.jobs import run_etl, run_queries, write_hours_csv
from gridtally.plans.pipeline import BuiltTables, Options, daily_table, hourly_table, hours_with_time
from gridtally.plans.reports import DAY_REPORTS, REPORTS, day_reports, similar_meters, top_meters_by_year
from gridtally.schemas import METER_DAYS
from gridtally.settings import HOURLY_TABLE
from gridtally.sources.meter_days import drop_repeated_meter_days, read_all_parquets
from gridtally.sources.tables import (
    meter_hours,
    read_sql_to_df,
    read_table,
    save_table,
    table_path,
    write_csv,
)

OPTIONS = Options(bins=BINS)
KEY = ["client_id", "ext_dev_ref", "date_local"]
HOUR_KEY = ["ext_dev_ref", "timestamp_local"]
SMALL_LIMIT = 200  # slices nearly every meter, to show that slicing changes nothing


def working_folder(spark: SparkSession) -> str:
    """A new folder that all executors see: below ``spark.checkpoint.dir``, or below the warehouse, which is shared too."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/gridtally-{uuid.uuid4().hex}"


def _kept(spark: SparkSession, result: DataFrame, root: str) -> DataFrame:
    """The result, written to a folder of its own, without the files below ``root``, which go."""
    own = working_folder(spark)
    result.write.parquet(own)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return spark.read.schema(result.schema).parquet(own)


def _six(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


def expand_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_daily_array_to_hourly(meter_raw(spark, sf_dir)).drop("timestamp_local")


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_meter_days(meter_raw(spark, sf_dir))


def local_timestamp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = expand_daily_array_to_hourly(meter_raw(spark, sf_dir))
    parsed = add_time_features_hourly(hours.withColumnRenamed("hour", "array_index"))
    return parsed.select("ext_dev_ref", "array_index", "timestamp_local", "timestamp")


def _mixed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of the hours in many notations: with offset, as UTC, naive, compact, and broken."""
    hour, local, utc = F.col("hour"), F.col("timestamp_local"), F.col("timestamp_utc")
    text = (
        F.when(hour % 4 == 0, local)
        .when(hour % 4 == 1, F.regexp_replace(utc, r"\+00:00$", "Z"))
        .when((hour % 4 == 3) | (hour == 2), F.substring(local, 1, 19))
        .when(hour == 6, F.concat(F.substring(utc, 1, 16), F.lit("z")))
        .when(hour == 10, F.concat(F.translate(F.substring(utc, 1, 19), "T", " "), F.lit(" UTC")))
        .when(hour == 14, F.substring(local, 1, 22))
        .when(hour == 18, F.translate(F.substring(local, 1, 19), "-:", ""))
        .otherwise(F.concat(F.lit("day "), F.col("date_local")))
    )
    return expand_daily_array_to_hourly(meter_raw(spark, sf_dir)).select(
        "ext_dev_ref", F.col("hour").alias("array_index"), "date_local", text.alias("text"))


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _mixed_texts(spark, sf_dir).withColumnRenamed("date_local", "day")
    return add_time_features_hourly(rows, "text").select("ext_dev_ref", "text", "timestamp")


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparsed_timestamps(_mixed_texts(spark, sf_dir), "text").select("ext_dev_ref", "text")


def hourly_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hours_with_time(meter_raw(spark, sf_dir))
    return hours.select(*HOUR_KEY, "timestamp", "hour", "date_local", "day_of_week", "is_weekend",
                        "month", "year")


def hourly_time_features_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hours_with_time(meter_raw(spark, sf_dir), Options(calendar="local"))
    return hours.select(*HOUR_KEY, "timestamp", "hour", "date_local", "day_of_week", "is_weekend",
                        "month", "year")


def hourly_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hours_with_time(meter_raw(spark, sf_dir))
    return add_lag_features(hours).select(*HOUR_KEY, "consumption_kwh", "lag_1h", "lag_24h")


def hourly_rolling_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hours_with_time(meter_raw(spark, sf_dir))
    return add_rolling_features_hourly(hours).select(
        *HOUR_KEY, *_six("rolling_mean_24h", "rolling_std_24h"))


def hourly_lookback_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hours_with_time(meter_raw(spark, sf_dir))
    lookback = Lookback(lags=(1, 24), window_hours=24)
    return add_lookback_features(hours, lookback, limit=SMALL_LIMIT).select(
        *HOUR_KEY, "lag_1h", "lag_24h", *_six("rolling_mean_24h", "rolling_std_24h"))


def hourly_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hourly_table(meter_raw(spark, sf_dir), OPTIONS)
    return hours.withColumns({n: F.round(n, 6) for n in ("rolling_mean_24h", "rolling_std_24h")})


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.aggregate_daily_measures(hours_with_time(meter_raw(spark, sf_dir)))


def daily_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measures(spark, sf_dir).select(
        *KEY, "total_kwh", "max_kwh", "hourly_count", *_six("mean_kwh", "std_kwh", "peak_to_mean_ratio"))


def daily_peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measures(spark, sf_dir).select(*KEY, "peak_hour", "peak_kwh")


def daily_night_evening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measures(spark, sf_dir).select(*KEY, "night_kwh", "day_kwh")


def daily_cumulative_and_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = d.aggregate_daily_from_hourly(hours_with_time(meter_raw(spark, sf_dir)))
    return days.select(*KEY, "cumulative_total_kwh", *_six("weekend_vs_weekday"))


def daily_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.add_rolling_aggregates_daily(_measures(spark, sf_dir)).select(
        *KEY, "rolling_7d_total_kwh", "rolling_30d_total_kwh")


def daily_calendar_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.add_season_and_holiday_flags(_measures(spark, sf_dir)).select(
        *KEY, "month", "season", "is_holiday", "is_summer_vacation")


def daily_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.categorize_daily_consumption(_measures(spark, sf_dir), BINS).select(
        *KEY, "total_kwh", "consumption_category")


_DAILY_ROUNDED = ("mean_kwh", "std_kwh", "peak_to_mean_ratio", "weekend_vs_weekday")


def daily_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily_table(meter_raw(spark, sf_dir), OPTIONS)
    return days.withColumns({n: F.round(n, 6) for n in _DAILY_ROUNDED})


def monthly_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_monthly_from_daily(_measures(spark, sf_dir))


def load_shape_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hours_with_time(meter_raw(spark, sf_dir))
    days = add_daily_load_shape_similarity(hours, d.aggregate_daily_measures(hours))
    return days.select(*KEY, F.round("daily_load_similarity", 9).alias("daily_load_similarity"))


def repeated_meter_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every meter-day read twice: totals with the copies and after removing them."""
    raw = meter_raw(spark, sf_dir)
    twice = raw.unionByName(raw)
    with_copies = d.aggregate_daily_measures(hours_with_time(twice))
    without = d.aggregate_daily_measures(hours_with_time(drop_repeated_meter_days(twice)))
    return with_copies.select(*KEY, F.col("total_kwh").alias("total_twice")).join(
        without.select(*KEY, "total_kwh"), KEY)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


_REPORT_MEANS = {
    "hourly_profile_avg": ["avg_kwh"],
    "peak_hours_distribution": ["avg_peak_kwh"],
    "holiday_vs_nonholiday": ["avg_daily_kwh"],
    "vacation_effect": ["avg_daily_kwh"],
    "consumption_categories": ["avg_daily_kwh"],
    "similar_meters": ["avg_daily_kwh"],
    "peak_to_mean_outliers": list(_DAILY_ROUNDED),
}


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = meter_raw(spark, sf_dir)
        tables = BuiltTables(raw, OPTIONS)
        result = REPORTS[name](tables)
        return _rounded(result, *_REPORT_MEANS.get(name, []))

    run.__name__ = name
    return run


def similar_meters_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = BuiltTables(meter_raw(spark, sf_dir), OPTIONS)
    return _rounded(similar_meters(tables, target_dev_ref="dev_3"), "avg_daily_kwh")


def _stored(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """The whole ETL from parquet files to stored tables, in a new folder."""
    root = working_folder(spark)
    meter_raw(spark, sf_dir).write.parquet(table_path(root, "input"))
    tables = run_etl(spark, table_path(root, "input/*.parquet"), table_path(root, "csv"),
                     table_path(root, "tables"), OPTIONS, save_rejects=True)
    return root, tables


def daily_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _stored(spark, sf_dir)
    return _rounded(tables["meter_daily_rolling_7d"], *_DAILY_ROUNDED)


def hourly_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = working_folder(spark)
    hours = hours_with_time(meter_raw(spark, sf_dir))
    save_table(hours, HOURLY_TABLE, root, partition_by=["year", "month"],
               sort_by=["ext_dev_ref", "timestamp"])
    save_table(hours, HOURLY_TABLE, root, if_exists="append", partition_by=["year", "month"],
               sort_by=["ext_dev_ref", "timestamp"])
    stored = spark.read.parquet(table_path(root, HOURLY_TABLE)).groupBy("year", "month").agg(
        F.count("*").alias("n_rows"), F.sum("consumption_kwh").alias("total_kwh"))
    return _kept(spark, stored, root)


def hourly_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(working_folder(spark), "hours.csv")
    hours = expand_daily_array_to_hourly(meter_raw(spark, sf_dir))
    write_csv(hours, path, order_by=HOUR_KEY)
    return spark.read.option("header", True).schema(hours.schema).csv(path).select(
        "client_id", "ext_dev_ref", "date_local", "hour", "timestamp_local", "consumption_kwh")


def parquet_scan_by_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of files, one without the optional column, read through one glob."""
    root = working_folder(spark)
    raw = meter_raw(spark, sf_dir)
    early = F.month("date") < 8
    raw.where(early).write.parquet(table_path(root, "early"))
    raw.where(~early).drop("resolution").write.parquet(table_path(root, "late"))
    return read_all_parquets(spark, f"{root}/*/*.parquet").select(*METER_DAYS.names).select(
        "client_id", "date", "ext_dev_ref", F.size("energy_consumption").alias("n_readings"), "resolution")


def sql_over_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = working_folder(spark)
    tables = BuiltTables(meter_raw(spark, sf_dir), OPTIONS)
    save_table(tables["meter_hourly"], "meter_hourly", root)
    save_table(tables["meter_daily"], "meter_daily", root)
    save_table(derive_monthly_from_daily(read_table(spark, "meter_daily", root)), "meter_monthly", root)
    result = read_sql_to_df(spark, """
        SELECT m.ext_dev_ref, m.year, m.month, m.monthly_total_kwh, h.hours, r.days
        FROM meter_monthly m
        JOIN (SELECT ext_dev_ref, year, month, count(consumption_kwh) AS hours
              FROM meter_hourly GROUP BY ext_dev_ref, year, month) h
          ON h.ext_dev_ref = m.ext_dev_ref AND h.year = m.year AND h.month = m.month
        JOIN (SELECT ext_dev_ref, year(date_local) AS year, month, count(*) AS days
              FROM meter_daily_rolling_7d GROUP BY ext_dev_ref, year(date_local), month) r
          ON r.ext_dev_ref = m.ext_dev_ref AND r.year = m.year AND r.month = m.month
    """, root)
    return _kept(spark, result, root)


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, tables = _stored(spark, sf_dir)
    reports = {"broken_report": _broken_report} | REPORTS
    status = run_queries(spark, tables, table_path(root, "reports"), reports)
    return _kept(spark, status.select("report", "status", "n_rows", "error"), root)


def _broken_report(tables):
    raise ValueError


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _stored(spark, sf_dir)
    return _kept(spark, spark.read.parquet(table_path(root, "tables/run_metrics")).select("step", "n_rows"), root)


def raw_csv_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted CSV read back file by file: every row with its place."""
    root = working_folder(spark)
    path = table_path(root, "hours.csv")
    raw = meter_raw(spark, sf_dir)
    write_hours_csv(raw, path)
    hours = expand_daily_array_to_hourly(raw)
    lines = spark.read.option("header", True).schema(hours.schema).csv(path).select(
        *HOUR_KEY, F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"))
    return _numbered(lines).select(*HOUR_KEY, "place")


def _numbered(lines: DataFrame) -> DataFrame:
    """``lines`` with their place in order of file and line: within the file, after the rows of the files before."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    offsets = lines.groupBy("file").count().select("file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("file").orderBy("line"))
    return lines.withColumn("place", within).join(offsets, "file").withColumn("place", F.col("place") + F.col("offset")).drop("offset")


def _in_order(df: DataFrame) -> DataFrame:
    """The rows of a report with their place, which its order gives."""
    return df.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


def top_meters_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest meters with a limit that cuts, in order."""
    return _in_order(top_meters_by_year(BuiltTables(meter_raw(spark, sf_dir), OPTIONS), rows=5))


def similar_meters_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest meters with a limit that cuts, in order."""
    return _in_order(similar_meters(BuiltTables(meter_raw(spark, sf_dir), OPTIONS), rows=3)).select("ext_dev_ref", "place")


def mixed_file_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sets of files: dates as DATE, as text and as timestamp, readings as integers and as doubles."""
    root = working_folder(spark)
    raw = meter_raw(spark, sf_dir)
    third = F.month("date") % 3
    midnight = F.to_timestamp(F.concat(F.col("date").cast("string"), F.lit("T00:00:00Z")))
    raw.where(third == 0).write.parquet(table_path(root, "a"))
    raw.where(third == 1).withColumns({
        "date": F.date_format("date", "MM/dd/yyyy"),
        "energy_consumption": F.col("energy_consumption").cast("array<double>")}).write.parquet(table_path(root, "b"))
    raw.where(third == 2).withColumn("date", midnight).write.parquet(table_path(root, "c"))
    hours = expand_daily_array_to_hourly(read_all_parquets(spark, f"{root}/*/*.parquet"))
    return hours.select("ext_dev_ref", "timestamp_utc", "consumption_kwh")


def repeated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over growing input replace the tables; days and months stand once."""
    root = working_folder(spark)
    raw = meter_raw(spark, sf_dir)
    half = F.month("date") < 7
    glob, tables = table_path(root, "input/*/*.parquet"), table_path(root, "tables")
    raw.where(half).write.parquet(table_path(root, "input/a"))
    run_etl(spark, glob, None, tables, OPTIONS)
    raw.where(~half).write.parquet(table_path(root, "input/b"))
    stored = run_etl(spark, glob, None, tables, OPTIONS)
    months = stored["meter_monthly"].groupBy("ext_dev_ref").agg(
        F.count("*").alias("months"), F.sum("days_with_data").alias("days"), F.sum("monthly_total_kwh").alias("total_kwh"))
    last = stored["meter_daily"].groupBy("ext_dev_ref").agg(
        F.count("*").alias("day_rows"), F.max("cumulative_total_kwh").alias("running_total"))
    return _kept(spark, months.join(last, "ext_dev_ref"), root)


def _after_runs(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, DataFrame]:
    """The stored tables after a run over the first days, and others over new ones alone.

    Every third meter comes up in the second run, every fifth ends in the first; the others' days are cut in ``runs`` parts.
    """
    root = working_folder(spark)
    raw = meter_raw(spark, sf_dir)
    number = F.regexp_extract("ext_dev_ref", "[0-9]+", 0).cast("int")
    first = raw.groupBy("ext_dev_ref").agg(F.min("date").alias("first"))
    day = F.datediff("date", "first")
    cut = F.when(day < 11, 0).when(day < 23, 1).otherwise(2)
    part = F.least(F.when(number % 5 == 4, 0).when(number % 3 == 2, F.greatest(cut, F.lit(1))).otherwise(cut), F.lit(runs - 1))
    parts = raw.join(first, "ext_dev_ref").withColumn("part", part).drop("first").select(*raw.columns, "part")
    tables = {}
    for k in range(runs):
        folder = table_path(root, f"input/{k}")
        parts.where(F.col("part") == k).drop("part").write.parquet(folder)
        tables = run_etl(spark, f"{folder}/*.parquet", None, table_path(root, "tables"), OPTIONS, if_exists="append")
    return tables


def incremental_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _after_runs(spark, sf_dir, 2)["meter_hourly"]
    return _rounded(hours, "rolling_mean_24h", "rolling_std_24h")


def incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_after_runs(spark, sf_dir, 3)["meter_daily"], *_DAILY_ROUNDED)


def incremental_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_runs(spark, sf_dir, 2)["meter_monthly"]


def meter_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One meter's hours over all stored months."""
    root = working_folder(spark)
    save_table(hours_with_time(meter_raw(spark, sf_dir)), HOURLY_TABLE, root, partition_by=["year", "month"],
               sort_by=["ext_dev_ref", "timestamp"], lookup=["ext_dev_ref"])
    return meter_hours(spark, root, "dev_3").groupBy("year", "month").agg(
        F.count("*").alias("hours"), F.sum("consumption_kwh").alias("total_kwh"), F.max("timestamp").alias("last_hour"))


def shared_day_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports that one pass over the daily table gives, one after the other."""
    made = day_reports(BuiltTables(meter_raw(spark, sf_dir), OPTIONS), DAY_REPORTS)
    columns = {
        "yearly_consumption": ("year", None, "yearly_kwh"), "peak_hours_distribution": ("peak_hour", "occurrences", "avg_peak_kwh"),
        "holiday_vs_nonholiday": ("is_holiday", "days", "avg_daily_kwh"),
        "vacation_effect": ("is_summer_vacation", "days", "avg_daily_kwh"),
        "consumption_categories": ("consumption_category", "cnt", "avg_daily_kwh"), "night_day_consumption": (None, None, None)}
    parts = [
        made[name]({}).select(
            F.lit(name).alias("report"), (F.col(key) if key else F.lit(None)).cast("string").alias("value"),
            (F.col(n) if n else F.lit(None)).cast("bigint").alias("days"),
            F.round(F.col(kwh) if kwh else F.col("night_kwh") + F.col("day_kwh"), 6).alias("kwh"))
        for name, (key, n, kwh) in columns.items()]
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        expand_hourly,
        rejected_rows,
        local_timestamp_text,
        parse_timestamps,
        parse_rejects,
        hourly_time_features,
        hourly_time_features_local,
        hourly_lags,
        hourly_rolling_24h,
        hourly_lookback_sliced,
        hourly_all_columns,
        daily_aggregate,
        daily_peak_hour,
        daily_night_evening,
        daily_cumulative_and_ratio,
        daily_rolling,
        daily_calendar_flags,
        daily_category,
        daily_all_columns,
        monthly_aggregate,
        load_shape_similarity,
        repeated_meter_days,
        *map(_report, REPORTS),
        similar_meters_of,
        parquet_scan_by_glob,
        hourly_csv_roundtrip,
        hourly_store_roundtrip,
        daily_store_roundtrip,
        sql_over_tables,
        run_status,
        run_metrics,
        raw_csv_order,
        top_meters_first_rows,
        similar_meters_first_rows,
        mixed_file_types,
        repeated_run,
        incremental_hourly,
        incremental_daily,
        incremental_monthly,
        meter_lookup,
        shared_day_reports,
    )
}
