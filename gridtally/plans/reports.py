"""The named reports over the stored tables.

A report is a function of the tables (name -> DataFrame); ``REPORTS`` is the
catalogue.  Orders are total, so that a report with a limit is the same every time.
"""

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.settings import DAILY_TABLE, HOURLY_TABLE, MONTHLY_TABLE, PLAIN_HOURS

Tables = Mapping[str, DataFrame]


def yearly_consumption(tables: Tables) -> DataFrame:
    year = F.year(F.to_date("date_local")).alias("year")
    return tables[DAILY_TABLE].groupBy(year).agg(F.sum("total_kwh").alias("yearly_kwh")).orderBy("year")


def top_meters_by_year(tables: Tables, rows: int = 100) -> DataFrame:
    """Largest (meter, year) totals, newest year first; ``rows`` in all, not per year."""
    return (
        tables[DAILY_TABLE]
        .groupBy("ext_dev_ref", F.year(F.to_date("date_local")).alias("year"))
        .agg(F.sum("total_kwh").alias("yearly_kwh"))
        .orderBy(F.desc("year"), F.desc("yearly_kwh"), "ext_dev_ref")
        .limit(rows)
    )


def hourly_profile_avg(tables: Tables) -> DataFrame:
    """Mean reading per hour; ``samples`` counts rows, also those without a reading."""
    # No column that looks back is read: tables that are built on demand have the hours without them.
    return (
        tables[PLAIN_HOURS if PLAIN_HOURS in tables else HOURLY_TABLE]
        .groupBy("hour")
        .agg(F.avg("consumption_kwh").alias("avg_kwh"), F.count("*").alias("samples"))
        .orderBy("hour")
    )


def peak_hours_distribution(tables: Tables) -> DataFrame:
    return (
        tables[DAILY_TABLE]
        .where(F.col("peak_hour").isNotNull())
        .groupBy("peak_hour")
        .agg(F.count("*").alias("occurrences"), F.avg("peak_kwh").alias("avg_peak_kwh"))
        .orderBy(F.desc("occurrences"), "peak_hour")
    )


def _mean_day_by(tables: Tables, flag: str, count: str) -> DataFrame:
    return tables[DAILY_TABLE].groupBy(flag).agg(
        F.count("*").alias(count), F.avg("total_kwh").alias("avg_daily_kwh"))


def holiday_vs_nonholiday(tables: Tables) -> DataFrame:
    return _mean_day_by(tables, "is_holiday", "days").orderBy(F.desc("is_holiday"))


def vacation_effect(tables: Tables) -> DataFrame:
    return _mean_day_by(tables, "is_summer_vacation", "days").orderBy(F.desc("is_summer_vacation"))


def monthly_trends(tables: Tables) -> DataFrame:
    return (
        tables[MONTHLY_TABLE]
        .groupBy("year", "month")
        .agg(F.sum("monthly_total_kwh").alias("total_kwh"))
        .orderBy("year", "month")
    )


def consumption_categories(tables: Tables) -> DataFrame:
    """Days and mean total per band; days outside all bands form a group of their own."""
    return _mean_day_by(tables, "consumption_category", "cnt").orderBy(
        F.desc("cnt"), "consumption_category")


def similar_meters(tables: Tables, target_dev_ref: str | None = None, rows: int = 50) -> DataFrame:
    """Meters whose mean day lies within 10 % of the target meter's, nearest first, the
    target included.  Without ``target_dev_ref`` the smallest meter id is the target."""
    mean_day = (
        tables[DAILY_TABLE].groupBy("ext_dev_ref").agg(F.avg("total_kwh").alias("avg_daily_kwh")))
    if target_dev_ref is None:
        target = mean_day.where(F.col("ext_dev_ref").isNotNull()).orderBy("ext_dev_ref").limit(1)
    else:
        target = mean_day.where(F.col("ext_dev_ref") == target_dev_ref)
    # A single number, read as a scalar subquery: neither a join nor a broadcast.
    wanted = target.select("avg_daily_kwh").scalar()
    average = F.col("avg_daily_kwh")
    return (
        mean_day.where(average.between(wanted * 0.9, wanted * 1.1))
        .orderBy(F.abs(average - wanted), "ext_dev_ref")
        .limit(rows)
    )


def night_day_consumption(tables: Tables) -> DataFrame:
    return tables[DAILY_TABLE].agg(
        F.sum("night_kwh").alias("night_kwh"), F.sum("day_kwh").alias("day_kwh"))


def peak_to_mean_outliers(tables: Tables, threshold: float = 2.5) -> DataFrame:
    """All columns of the days whose peak exceeds ``threshold`` times their mean."""
    return (
        tables[DAILY_TABLE]
        .where(F.col("peak_to_mean_ratio") > threshold)
        .orderBy(F.desc("peak_to_mean_ratio"), "ext_dev_ref", "date_local", "client_id")
    )


def day_measures(daily: DataFrame) -> DataFrame:
    """Counts, sums and means of all days by year, peak hour, holiday, vacation and band, each by itself: a row per value
    of each, in one pass.  ``by`` names what a row is grouped by."""
    keys = {"year": F.year(F.to_date("date_local")), **{k: F.col(k) for k in _DAY_KEYS if k != "year"}}
    days = daily.select(*[c.alias(k) for k, c in keys.items()], "total_kwh", "peak_kwh", "night_kwh", "day_kwh")
    sets = [[F.col(k)] for k in keys] + [[]]
    # In a row grouped by one key all others are null, but so may be the key itself; grouping() tells.
    by = F.coalesce(*[F.when(F.grouping(k) == 0, k) for k in keys], F.lit("all"))
    return days.groupingSets(sets, *keys).agg(
        by.alias("by"), F.count("*").alias("days"), F.sum("total_kwh").alias("sum_total"), F.avg("total_kwh").alias("avg_total"),
        F.avg("peak_kwh").alias("avg_peak"), F.sum("night_kwh").alias("night_kwh"), F.sum("day_kwh").alias("day_kwh"))


# What the common pass groups days by, and the reports that read it: rows, columns and order.
_DAY_KEYS = ("year", "peak_hour", "is_holiday", "is_summer_vacation", "consumption_category")
DAY_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "yearly_consumption": lambda m: m.where("by = 'year'").select("year", F.col("sum_total").alias("yearly_kwh")).orderBy("year"),
    "peak_hours_distribution": lambda m: m.where("by = 'peak_hour' AND peak_hour IS NOT NULL").select(
        "peak_hour", F.col("days").alias("occurrences"), F.col("avg_peak").alias("avg_peak_kwh")).orderBy(F.desc("occurrences"), "peak_hour"),
    "holiday_vs_nonholiday": lambda m: m.where("by = 'is_holiday'").select(
        "is_holiday", "days", F.col("avg_total").alias("avg_daily_kwh")).orderBy(F.desc("is_holiday")),
    "vacation_effect": lambda m: m.where("by = 'is_summer_vacation'").select(
        "is_summer_vacation", "days", F.col("avg_total").alias("avg_daily_kwh")).orderBy(F.desc("is_summer_vacation")),
    "consumption_categories": lambda m: m.where("by = 'consumption_category'").select(
        "consumption_category", F.col("days").alias("cnt"), F.col("avg_total").alias("avg_daily_kwh")).orderBy(
            F.desc("cnt"), "consumption_category"),
    "night_day_consumption": lambda m: m.where("by = 'all'").select("night_kwh", "day_kwh"),
}


def day_reports(tables: Tables, names: Iterable[str]) -> dict[str, Callable[[Tables], DataFrame]]:
    """The named ones of DAY_REPORTS, from one scan of the daily table.

    The measures have a row per year, hour, flag and band: a few dozen, which are kept on the driver.
    """
    daily = tables[DAILY_TABLE]
    found = day_measures(daily)
    kept = daily.sparkSession.createDataFrame(found.collect(), found.schema)
    return {name: lambda _, make=DAY_REPORTS[name]: make(kept) for name in names}


REPORTS: dict[str, Callable[..., DataFrame]] = {
    report.__name__: report
    for report in (
        yearly_consumption,
        top_meters_by_year,
        hourly_profile_avg,
        peak_hours_distribution,
        holiday_vs_nonholiday,
        vacation_effect,
        monthly_trends,
        consumption_categories,
        similar_meters,
        night_day_consumption,
        peak_to_mean_outliers,
    )
}

# Reports with a limit or a row per calendar value: their size doesn't follow the data.
BOUNDED_REPORTS = frozenset(REPORTS) - {"peak_to_mean_outliers"}
