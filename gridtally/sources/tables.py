"""Stored tables, CSV files and SQL over them."""

import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.operators.daily import METER_KEY, add_ratio
from gridtally.schemas import DAILY, HOURLY, MONTHLY
from gridtally.settings import (
    DAILY_ROLLING_VIEW,
    DAILY_TABLE,
    HOURLY_TABLE,
    LOOKUP_VALUES,
    MAX_ROWS_PER_FILE,
    MONTHLY_TABLE,
    TOTALS_TABLE,
)
from gridtally.sources import versions

log = logging.getLogger(__name__)

_WRITE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
_SCHEMAS = {HOURLY_TABLE: HOURLY, DAILY_TABLE: DAILY, MONTHLY_TABLE: MONTHLY}


def table_path(root: str, name: str) -> str:
    return f"{str(root).rstrip('/')}/{name}"


def save_table(df: DataFrame, table_name: str, root: str, if_exists: str = "replace",
               partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), lookup: Sequence[str] = ()) -> str:
    """Write a parquet table and return its path.

    ``partition_by`` gives folders that a filter can skip; rows sorted by
    ``sort_by`` inside a file let parquet statistics skip row groups.  Both stand
    where a database would have indexes.

    With folders the rows are shuffled to them first, so that the number of files follows
    the size of the folders and not the number of tasks: Spark splits a large folder and
    joins small ones by its advisory partition size, and no file has more than
    MAX_ROWS_PER_FILE rows.

    ``lookup`` names columns that rows are looked up by: every row group gets a Bloom filter of them, so that a reader
    passes over the groups without the value, in whichever folder, where ranges of sorted values are too wide to tell.
    """
    if if_exists not in _WRITE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(_WRITE_MODES)}")
    path = table_path(root, table_name)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(_WRITE_MODES[if_exists]).option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for column in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(LOOKUP_VALUES))
    writer.parquet(path)
    log.info("saved table %s", path)
    return path


def _as_declared(df: DataFrame, table_name: str) -> DataFrame:
    """Columns in the declared order (folder columns come last on disk), further ones after them."""
    schema: T.StructType = _SCHEMAS[table_name]
    first = [c for c in schema.names if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def read_table(spark: SparkSession, table_name: str, root: str, manifest: versions.Manifest | None = None) -> DataFrame:
    """A stored table: what the manifest names, or the newest one; without any, the table's folder itself."""
    manifest = manifest or versions.current(spark, root)
    if manifest is not None and table_name in manifest.folders:
        stored = versions.open_folders(spark, root, table_name, manifest.folders[table_name])
        if stored is None:
            return spark.createDataFrame([], _SCHEMAS[table_name])
        if table_name == DAILY_TABLE:
            stored = _with_ratio(stored, versions.open_folders(spark, root, TOTALS_TABLE, manifest.folders[TOTALS_TABLE]))
        return _as_declared(stored, table_name)
    try:
        df = spark.read.parquet(table_path(root, table_name))
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], _SCHEMAS[table_name])  # a partitioned table without rows has no file
    return _as_declared(df, table_name)


def meter_hours(spark: SparkSession, root: str, meter: str, since=None, until=None) -> DataFrame:
    """One meter's hours between two naive times (``until`` excluded), in order.

    Folders outside the months are not opened; within them the Bloom filters and the ranges of sorted values let the reader
    pass over the row groups without the meter.
    """
    hours = read_table(spark, HOURLY_TABLE, root).where(F.col("ext_dev_ref") == meter)
    month, at = F.col("year") * 12 + F.col("month"), F.col("timestamp")
    as_month = lambda t: F.year(t) * 12 + F.month(t)
    for limit, keep in ((since, lambda t: (month >= as_month(t)) & (at >= t)), (until, lambda t: (month <= as_month(t)) & (at < t))):
        if limit is not None:
            hours = hours.where(keep(F.lit(str(limit)).cast("timestamp_ntz")))
    return hours.orderBy("timestamp", "timestamp_local")


def _with_ratio(daily: DataFrame, totals: DataFrame) -> DataFrame:
    """The stored days with their share of the meter's mean day, which changes with every run and so is not stored.

    Catalyst sees that the right side has one row per meter and drops the join where the share is not asked for.
    """
    mean = totals.where("latest").groupBy(*METER_KEY).agg(F.first(F.col("running_total") / F.col("days_so_far")).alias("_mean"))
    return add_ratio(daily.join(mean, METER_KEY, "left"), F.col("_mean")).drop("_mean", "days_so_far", "stored_month")


def open_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored tables by name; the rolling name is a second name of the daily table."""
    manifest = versions.current(spark, root)  # once, so that all tables are of one run
    tables = {name: read_table(spark, name, root, manifest) for name in _SCHEMAS}
    tables[DAILY_ROLLING_VIEW] = tables[DAILY_TABLE]
    return tables


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_sql_to_df(spark: SparkSession, sql: str, root: str | None = None) -> DataFrame:
    """Result of a SQL text over the tables under ``root`` (or over views already there).

    The tables are views of a session of their own, so that views of the same names stay as the caller has them.
    """
    if root is None:
        return spark.sql(sql)
    own = spark.newSession()
    register_views(open_tables(own, root))
    return own.sql(sql)


def write_csv(df: DataFrame, path: str, order_by: Sequence[str] = (), single_file: bool = False) -> None:
    """Write a folder of CSV files with headers, replacing an earlier one.

    With ``order_by`` the files are sorted one after the other.  Rows that tie are
    told apart by a running id, so that many copies do not end up in one task.
    ``single_file`` is for reports whose size does not grow with the data.
    """
    if order_by:
        tie = "_tie"
        df = df.withColumn(tie, F.monotonically_increasing_id()).orderBy(*order_by, tie).drop(tie)
    if single_file:
        df = df.coalesce(1)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
