"""Meter-days to hours."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions import times
from gridtally.functions.readings import reading
from gridtally.settings import HOURS_PER_DAY, LOCAL_TZNAME


def check_columns(df: DataFrame, date_col: str, arr_col: str) -> None:
    missing = {"client_id", "ext_dev_ref", date_col, arr_col} - set(df.columns)
    if missing:
        raise ValueError(f"input lacks the columns {sorted(missing)}")


def _array_size(arr_col: str) -> Column:
    return F.coalesce(F.size(arr_col), F.lit(-1))


def reject_reason(df: DataFrame, date_col: str = "date",
                  arr_col: str = "energy_consumption") -> Column:
    """Why a meter-day cannot be expanded; null for a good one."""
    return (
        F.when(_array_size(arr_col) < 0, "no array")
        .when(_array_size(arr_col) != HOURS_PER_DAY, "wrong array size")
        .when(times.to_day(df, date_col).isNull(), "no date")
    )


def rejected_meter_days(df: DataFrame, date_col: str = "date",
                        arr_col: str = "energy_consumption") -> DataFrame:
    """Meter-days that the expansion skips, with the reason."""
    check_columns(df, date_col, arr_col)
    return df.select(
        "client_id",
        "ext_dev_ref",
        F.col(date_col).cast("string").alias("date"),
        F.size(arr_col).alias("array_size"),
        reject_reason(df, date_col, arr_col).alias("reason"),
    ).where(F.col("reason").isNotNull())


def expand_daily_array_to_hourly(df: DataFrame, date_col: str = "date",
                                 arr_col: str = "energy_consumption",
                                 timezone: str = LOCAL_TZNAME,
                                 keep: Sequence[str] = (),
                                 utc_col: str | None = None) -> DataFrame:
    """One row per hour of every meter-day whose array has exactly 24 readings.

    All hours of a day carry the offset of its local midnight, also on the days
    of a clock change.  ``keep`` names further input columns to carry along;
    ``utc_col`` names a column to add with the hour's start in naive UTC, which
    spares the next step from parsing the text again.
    """
    check_columns(df, date_col, arr_col)
    resolution = F.col("resolution") if "resolution" in df.columns else F.lit(None)

    # Whatever depends on the day alone is computed here, once per 24 hours; an hour
    # then only picks from it.  The UTC hours of a local day fall on two dates.
    day, midnight = F.col("_day"), F.col("_midnight")
    days = (
        df.where(_array_size(arr_col) == HOURS_PER_DAY)
        .select("client_id", "ext_dev_ref", resolution.cast("string").alias("resolution"),
                times.to_day(df, date_col).alias("_day"), F.col(arr_col).alias("_readings"), *keep)
        .where(day.isNotNull())
        .withColumn("_midnight", times.utc_midnight(day, timezone))
    )
    days = days.select(
        "client_id", "ext_dev_ref", "resolution", "_readings", *keep,
        day.cast("string").alias("date_local"),
        F.concat(F.lit(":00:00"), times.midnight_offset_text(day, midnight)).alias("_local_end"),
        times.hours_from(midnight, HOURS_PER_DAY).alias("_utc"),
        F.to_date(midnight).cast("string").alias("_utc_day"),
        F.date_add(F.to_date(midnight), 1).cast("string").alias("_utc_next_day"),
        F.concat(F.substring(midnight.cast("string"), 14, 6), F.lit("+00:00")).alias("_utc_end"),
        F.hour(midnight).alias("_utc_first_hour"),
    )
    # A select of its own, because Spark evaluates what stands beside an explode after
    # it.  Plain explode, because an adaptive plan sees through it that an empty input
    # has an empty result, and through posexplode not.
    hours = days.select("*", F.explode(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1))).alias("hour"))
    hours = hours.withColumn("_reading", F.get("_readings", "hour"))
    utc_hour = F.col("_utc_first_hour") + F.col("hour")
    utc_day = F.when(utc_hour < HOURS_PER_DAY, F.col("_utc_day")).otherwise(F.col("_utc_next_day"))
    columns = [
        "client_id", "ext_dev_ref", "resolution", "date_local", "hour",
        F.concat("date_local", times.hour_text(F.col("hour")), "_local_end").alias("timestamp_local"),
        F.concat(utc_day, times.hour_text(utc_hour % HOURS_PER_DAY), "_utc_end").alias("timestamp_utc"),
        reading(hours, "_reading").alias("consumption_kwh"),
        *keep,
    ]
    if utc_col is not None:
        columns.append(F.get("_utc", "hour").alias(utc_col))
    return hours.select(*columns)
