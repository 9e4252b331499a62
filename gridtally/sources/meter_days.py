"""Parquet source of meter-days."""

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.functions.times import to_day
from gridtally.schemas import METER_DAYS

log = logging.getLogger(__name__)

SOURCE_ROW = "source_row"
REQUIRED = {"client_id", "ext_dev_ref", "date", "energy_consumption"}


# Fixed value: what Spark calls files whose types can't be read as one.
_MIXED = "CANNOT_MERGE_SCHEMAS"


def read_all_parquets(spark: SparkSession, glob_pattern: str, schema: T.StructType | None = None,
                      source_row: bool = False) -> DataFrame:
    """All files of a glob as one frame, matched by column name.

    Without ``schema`` the footers of all files are merged (Spark does that in a
    job of its own); pass the declared ``schema`` to skip that on a large store, which
    still reads one footer and raises where that lacks a required column.
    Files of different types are read type by type and cast to the declared types, dates
    to text.  ``source_row`` adds an id of the row's place in the store, which tells equal
    copies of a meter-day apart.  No matching file gives an empty frame.
    """
    try:
        if schema is None:
            df = _placed(spark.read.option("mergeSchema", True).parquet(glob_pattern), source_row)
        else:
            missing = {f.name for f in schema} & REQUIRED - set(spark.read.parquet(glob_pattern).columns)
            if missing:
                raise ValueError(f"input lacks the columns {sorted(missing)}")
            df = _placed(spark.read.schema(schema).parquet(glob_pattern), source_row)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no parquet file matches %s", glob_pattern)
        df = spark.createDataFrame([], schema or METER_DAYS)
        return df.withColumn(SOURCE_ROW, F.lit(0).cast("bigint")) if source_row else df
    except Py4JJavaError as error:  # the one condition that Spark doesn't pass on as an exception of its own
        if _MIXED not in str(error.java_exception):
            raise
        df = _by_types(spark, glob_pattern, source_row)
    return df


def _placed(df: DataFrame, source_row: bool) -> DataFrame:
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return df.select("*", place.alias(SOURCE_ROW)) if source_row else df


def _by_types(spark: SparkSession, glob_pattern: str, source_row: bool) -> DataFrame:
    """Files with the same footer schema are read together, cast to the declared types and united by name."""
    files = [r["path"] for r in spark.read.format("binaryFile").load(glob_pattern).select("path").collect()]
    groups: dict[str, list[str]] = {}
    for path in sorted(files):
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    declared = {f.name: f.dataType for f in METER_DAYS}
    united = None
    for paths in groups.values():
        df = _placed(spark.read.parquet(*paths), source_row)
        kinds = {n: df.schema[n].dataType for n in declared if n in df.columns}
        casts = {n: F.col(n).cast(T.StringType() if isinstance(declared[n], T.DateType) else
                                  T.ArrayType(T.DoubleType()) if isinstance(declared[n], T.ArrayType) else declared[n])
                 for n in kinds}
        if "date" in kinds and not isinstance(kinds["date"], T.StringType):
            casts["date"] = to_day(df, "date").cast("string")
        df = df.withColumns(casts)
        united = df if united is None else united.unionByName(df, allowMissingColumns=True)
    return united


def drop_repeated_meter_days(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Keep one row per client, meter and date, the first by place in the store (or else by
    readings).  Off by default everywhere: repeated meter-days count twice unless a caller
    asks for this step."""
    keys = ["client_id", "ext_dev_ref", date_col]
    rest = [c for c in df.columns if c not in keys]
    order = [SOURCE_ROW] if SOURCE_ROW in rest else rest
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])
