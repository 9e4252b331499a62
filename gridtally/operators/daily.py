"""Hours to days: measures, calendar flags, rolling means and bands."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.functions import calendar
from gridtally.functions.readings import DEFAULT_BINS, DEFAULT_LABELS, band, reading
from gridtally.settings import HOURS_PER_DAY

METER_KEY = ["client_id", "ext_dev_ref"]

# Hours counted as night and as day (the evening), both ends included.
NIGHT_HOURS = (0, 6)
DAY_HOURS = (18, 23)


def _meter_days_in_order():
    # A meter has one daily row per calendar date, however many readings it has,
    # so these groups stay small.
    return Window.partitionBy(*METER_KEY).orderBy("date_local")


def _with_date(df: DataFrame) -> DataFrame:
    if "date_local" in df.columns:
        return df
    if "timestamp" in df.columns:
        return df.withColumn("date_local", F.to_date("timestamp"))
    raise KeyError("date_local or timestamp is required")


def aggregate_daily_measures(df: DataFrame) -> DataFrame:
    """Measures of every client, meter and date; rows with a null key are left out.

    One aggregate gives everything.  The peak hour is the first hour that reaches
    the day's maximum: one maximum per hour of the day keeps the aggregation in
    fixed-width buffers, where a maximum over (reading, hour) pairs would have to
    sort all hours first.
    """
    df = _with_date(df)
    kwh = F.col("kwh")
    sum_between = lambda first, last: F.coalesce(
        F.expr(f"sum(kwh) FILTER (WHERE hour BETWEEN {first} AND {last})"), F.lit(0.0))
    hours = (
        df.select(*METER_KEY, "date_local", "hour", reading(df).alias("kwh"))
        .dropna(subset=[*METER_KEY, "date_local"])
    )
    days = hours.groupBy(*METER_KEY, "date_local").agg(
        F.coalesce(F.sum(kwh), F.lit(0.0)).alias("total_kwh"),
        F.avg(kwh).alias("mean_kwh"),
        F.max(kwh).alias("max_kwh"),
        F.stddev_samp(kwh).alias("std_kwh"),
        F.count(kwh).alias("hourly_count"),
        sum_between(*NIGHT_HOURS).alias("night_kwh"),
        sum_between(*DAY_HOURS).alias("day_kwh"),
        F.array(*[F.expr(f"max(kwh) FILTER (WHERE hour = {h})") for h in range(HOURS_PER_DAY)])
        .alias("_by_hour"),
    )
    peak_hour = F.array_position("_by_hour", F.col("max_kwh")).cast("int") - 1
    return days.select(
        *METER_KEY, "date_local", "total_kwh", "mean_kwh", "max_kwh", "std_kwh", "hourly_count",
        peak_hour.alias("peak_hour"),
        F.col("max_kwh").alias("peak_kwh"),
        F.coalesce(F.try_divide("max_kwh", "mean_kwh"), F.lit(0.0)).alias("peak_to_mean_ratio"),
        "night_kwh", "day_kwh",
    )


def add_cumulative(days: DataFrame, before: str | None = None) -> DataFrame:
    """Running total of a meter and ``days_so_far``, its days up to this one.

    ``before`` may name a struct column (total, days) with what stands before a row's own share; it is added where it isn't
    null, instead of the row itself.
    """
    up_to_day = _meter_days_in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total, one = F.col("total_kwh"), F.lit(1).cast("bigint")
    if before is not None:
        total, one = F.coalesce(f"{before}.total", total), F.coalesce(f"{before}.days", one)
    return days.withColumns({
        "cumulative_total_kwh": F.sum(total).over(up_to_day),
        "days_so_far": F.sum(one).over(up_to_day),
    })


def add_ratio(days: DataFrame, mean: Column) -> DataFrame:
    """Each day's total over the meter's mean day."""
    return days.withColumn("weekend_vs_weekday", F.try_divide(F.col("total_kwh"), mean + F.lit(1e-6)))


def add_cumulative_and_ratio(days: DataFrame) -> DataFrame:
    """Running total of a meter, and each day's total over the meter's mean day."""
    all_days = _meter_days_in_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return add_ratio(add_cumulative(days), F.avg("total_kwh").over(all_days)).drop("days_so_far")


def aggregate_daily_from_hourly(df: DataFrame) -> DataFrame:
    """One row per client, meter and date with totals, peak, night, evening and running total."""
    return add_cumulative_and_ratio(aggregate_daily_measures(df))


def add_season_and_holiday_flags(df_daily: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Add ``month``, ``season``, ``is_holiday`` and ``is_summer_vacation``.

    ``holidays`` may be any frame with a ``holiday_date`` column; without it the date itself tells.
    """
    df = _with_date(df_daily)
    day, month = F.to_date("date_local"), F.month(F.to_date("date_local"))
    holiday = calendar.is_holiday(day)
    if holidays is not None:
        df = df.join(holidays.select("holiday_date").distinct(), day == F.col("holiday_date"), "left")
        holiday = F.col("holiday_date").isNotNull()
    flagged = df.withColumns({
        "month": month,
        "season": calendar.season(month),
        "is_holiday": holiday.cast("int"),
        "is_summer_vacation": calendar.is_summer_vacation(month),
    }).drop("holiday_date")
    return flagged if "date_local" in df_daily.columns else flagged.drop("date_local")


def add_rolling_aggregates_daily(df_daily: DataFrame, windows: Sequence[int] = (7, 30)) -> DataFrame:
    """Add ``rolling_{n}d_total_kwh``: mean total of the last n daily rows, this one included."""
    if "date_local" not in df_daily.columns:
        raise KeyError("date_local is required")
    in_order = _meter_days_in_order()
    return df_daily.withColumns({
        f"rolling_{n}d_total_kwh": F.bround(F.avg("total_kwh").over(in_order.rowsBetween(1 - n, 0)), 6)
        for n in windows
    })


def categorize_daily_consumption(df_daily: DataFrame, bins: Sequence[float] | None = None,
                                 labels: Sequence[str] | None = None) -> DataFrame:
    """Add ``consumption_category``, the right-closed band of the day's total."""
    chosen = band(F.col("total_kwh"), DEFAULT_BINS if bins is None else bins,
                  DEFAULT_LABELS if labels is None else labels)
    return df_daily.withColumn("consumption_category", chosen)
