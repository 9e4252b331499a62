"""A run over new meter-days alone, which leaves the stored tables as one run over everything would.

What a new day needs of the past is small and kept per meter: the last meter-days, whose hours the lags and rolling windows
reach back to and with which the day of the clock change between local and UTC dates is complete, and the last daily rows with the
running total and number of days.  New hours are added; the months that new days fall into are written anew from the stored
ones; nothing else is read or written.
"""

import re
from collections import Counter
from dataclasses import fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.functions.times import to_day
from gridtally.operators.daily import (
    METER_KEY,
    add_cumulative,
    add_rolling_aggregates_daily,
    add_season_and_holiday_flags,
    aggregate_daily_measures,
    categorize_daily_consumption,
)
from gridtally.operators.expand import reject_reason
from gridtally.operators.lookback import METER, Lookback
from gridtally.operators.monthly import derive_monthly_from_daily
from gridtally.plans.pipeline import Options, daily_table, hourly_table, hours_with_time
from gridtally.settings import DAILY_TABLE, HOURLY_TABLE, HOURS_PER_DAY, LAST_DAYS_TABLE, MONTHLY_TABLE, TOTALS_TABLE
from gridtally.sources import versions
from gridtally.sources.meter_days import SOURCE_ROW
from gridtally.sources.tables import save_table, table_path

CONTEXT = "_context"
STORED_MONTH = "stored_month"
DAY_COLUMNS = ["date_local", "total_kwh", "running_total", "days_so_far"]

#: Table -> columns that make its folders, columns that its files are sorted by.
LAYOUT = {
    HOURLY_TABLE: (["year", "month"], [METER, "timestamp"]),
    DAILY_TABLE: ([STORED_MONTH], [METER, "date_local"]),
    MONTHLY_TABLE: (["year", "month"], [METER]),
    LAST_DAYS_TABLE: ([], [METER]),
    TOTALS_TABLE: ([], [METER]),
}


class LateMeterDays(ValueError):
    """New meter-days that don't come after those already stored of their meter."""


def fingerprint(options: Options) -> dict:
    """The options that stored tables depend on, as they stand in a manifest."""
    left_out = {"holidays", "hourly_partitions", "max_rows_per_slice", "date_col", "arr_col"}
    plain = lambda v: list(v) if isinstance(v, (list, tuple)) else v
    return {f.name: plain(getattr(options, f.name)) for f in fields(options) if f.name not in left_out}


def plain_days(placed: DataFrame, options: Options) -> DataFrame:
    """Meter-days in one form whatever the files' types: dates as DATE, readings as doubles."""
    value = F.col(options.arr_col)
    kind = placed.schema[options.arr_col].dataType.elementType
    as_double = lambda x: F.when(~F.isnan(x.cast("double")), x.cast("double")) if kind.typeName() in ("double", "float") else x.cast("double")
    resolution = F.col("resolution") if "resolution" in placed.columns else F.lit(None)
    return placed.select(
        "client_id", METER, to_day(placed, options.date_col).alias(options.date_col),
        F.transform(value, as_double).alias(options.arr_col), resolution.cast("string").alias("resolution"), SOURCE_ROW)


def good_days(days: DataFrame, options: Options) -> DataFrame:
    """The meter-days that are expanded."""
    return days.where(reject_reason(days, options.date_col, options.arr_col).isNull())


class Counts:
    """Numbers of meter-days read, rejected and without a date, taken in the pass that makes the hourly table."""

    def __init__(self, options: Options):
        self.options, self.observation = options, Observation()

    def of(self, days: DataFrame) -> tuple[Observation, list[Column]]:
        """What to observe of ``days``; those carried over from earlier runs don't count."""
        own = ~F.col(CONTEXT) if CONTEXT in days.columns else F.lit(True)
        reason = reject_reason(days, self.options.date_col, self.options.arr_col)
        return self.observation, [F.count_if(own).alias("read"), F.count_if(own & reason.isNotNull()).alias("rejected"),
                                  F.count_if(own & reason.eqNullSafe("no date")).alias("unparsed")]

    def checked(self, days: DataFrame, hours: int) -> dict[str, int]:
        """The counts, if they fit the ``hours`` that are stored.  A task that ran twice counts twice; then the
        input is counted once more."""
        # Without any hour the adaptive plan may have left out the pass that is observed.
        found = self.observation.get if hours else {"read": -1, "rejected": 0}
        if (found["read"] - found["rejected"]) * HOURS_PER_DAY == hours:
            return found
        return days.agg(*Counts(self.options).of(days)[1]).first().asDict()


def last_days(days: DataFrame, options: Options) -> DataFrame:
    """The meter-days that the next run needs: of every meter the last dates that hold all rows its windows look back at,
    and the last date of every client and meter.  Dates come whole, with all their copies."""
    date = options.date_col
    need = -(-Lookback(tuple(options.lags), options.window_hours).depth // HOURS_PER_DAY)
    known = days.where(F.col(METER).isNotNull())
    later = Window.partitionBy(METER).orderBy(F.desc(date)).rowsBetween(Window.unboundedPreceding, -1)
    of_meter = (known.groupBy(METER, date).agg(F.count("*").alias("_n"))
                .withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0)))
                .groupBy(METER).agg(F.min(F.when(F.col("_later") < need, F.col(date))).alias("_from")))
    of_client = known.groupBy(*METER_KEY).agg(F.max(date).alias("_last"))
    return (known.join(of_meter, METER).join(of_client, METER_KEY, "left")
            .where((F.col(date) >= F.col("_from")) | (F.col(date) == F.col("_last"))).select(*days.columns))


def last_totals(days: DataFrame, options: Options) -> DataFrame:
    """The last daily rows of every client and meter, enough for the rolling means and one day more, which may be incomplete."""
    newest = Window.partitionBy(*METER_KEY).orderBy(F.desc("date_local"))
    return (days.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= max([*options.rolling_days, 2]))
            .select(*METER_KEY, *DAY_COLUMNS, (F.col("_place") == 1).alias("latest")))


def _month_key(day: str):
    return F.year(day) * 100 + F.month(day)


class Run:
    """One run's writes; ``publish`` makes them current."""

    def __init__(self, spark: SparkSession, root: str, options: Options, before: versions.Manifest | None):
        self.spark, self.root, self.options, self.before, self.id = spark, root, options, before, versions.new_run()
        self.folders: dict[str, list[str]] = {}
        self.rows: dict[str, int] = {}

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Store ``df`` in folders of this run and give it as stored."""
        partition_by, sort_by = LAYOUT[table]
        save_table(df, f"{versions.RUN}={self.id}", table_path(self.root, table), "fail", partition_by, sort_by, lookup=[METER])
        self.folders[table] = versions.folders_of(self.spark, self.root, table, self.id, partition_by)
        found = versions.open_folders(self.spark, self.root, table, self.folders[table])
        stored = self.spark.createDataFrame([], df.schema) if found is None else found.select(*df.columns)
        if table not in (TOTALS_TABLE, LAST_DAYS_TABLE):
            self.rows[table] = stored.count()  # from the files' footers
        return stored

    def publish(self) -> versions.Manifest:
        return versions.publish(self.spark, self.root, self.before, self.folders, fingerprint(self.options))


def write_all(run: Run, raw: DataFrame, placed: DataFrame) -> dict[str, int]:
    """The tables of a run over all input; gives the counts of meter-days."""
    options, counts = run.options, Counts(run.options)
    run.write(hourly_table(placed, options, meters=raw, seen=counts.of(placed)), HOURLY_TABLE)
    days = daily_table(raw, options).drop("weekend_vs_weekday", "cumulative_total_kwh")
    daily = run.write(add_cumulative(days).withColumn(STORED_MONTH, _month_key("date_local")), DAILY_TABLE)
    run.write(derive_monthly_from_daily(daily), MONTHLY_TABLE)
    run.write(last_totals(daily.withColumnRenamed("cumulative_total_kwh", "running_total"), options), TOTALS_TABLE)
    run.write(last_days(good_days(plain_days(placed, options), options), options), LAST_DAYS_TABLE)
    return counts.checked(raw, run.rows[HOURLY_TABLE])


def write_new(run: Run, placed: DataFrame) -> dict[str, int]:
    """The tables of a run over new input, from those of the run before; gives the counts of meter-days."""
    options, date, before, counts = run.options, run.options.date_col, run.before, Counts(run.options)
    if dict(before.options) != fingerprint(options):
        raise ValueError("the stored tables were made with other options")
    plain = plain_days(placed, options)
    new = good_days(plain, options)
    opened = lambda table: versions.open_folders(run.spark, run.root, table, before.folders[table])
    old_days, old_totals = opened(LAST_DAYS_TABLE), opened(TOTALS_TABLE)
    firsts = new.where(F.col(METER).isNotNull()).groupBy(METER).agg(F.min(date).alias("_first"))
    late = old_days.groupBy(METER).agg(F.max(date).alias("_last")).join(firsts, METER).where("_first <= _last")
    if not late.isEmpty():
        raise LateMeterDays("new meter-days don't come after the stored ones, so that later rows would change: run over all input")

    touched = old_days.join(firsts.select(METER), METER, "left_semi")
    days = plain.withColumn(CONTEXT, F.lit(False)).unionByName(touched.select(*plain.columns).withColumn(CONTEXT, F.lit(True)))
    hours = hourly_table(days, options, keep=[CONTEXT], seen=counts.of(days)).where(~F.col(CONTEXT)).drop(CONTEXT)
    run.write(hours, HOURLY_TABLE)
    new_hours = run.folders[HOURLY_TABLE]
    run.folders[HOURLY_TABLE] = [*before.folders[HOURLY_TABLE], *run.folders[HOURLY_TABLE]]

    wide = hours_with_time(days, options, keep=[CONTEXT])
    first_day = wide.where(~F.col(CONTEXT)).dropna(subset=METER_KEY).groupBy(*METER_KEY).agg(F.min("date_local").alias("_first"))
    measures = aggregate_daily_measures(wide).join(first_day, METER_KEY).where("date_local >= _first").drop("_first")
    # Of the days before only the totals count, for the rolling means, and of the last of them what it adds up to.
    kept = old_totals.join(first_day, METER_KEY).where("date_local < _first")
    newest = Window.partitionBy(*METER_KEY).orderBy(F.desc("date_local"))
    last = F.row_number().over(newest) == 1
    sum_before = F.struct(F.when(last, F.col("running_total")).otherwise(F.lit(0.0)).alias("total"),
                          F.when(last, F.col("days_so_far")).otherwise(F.lit(0)).cast("bigint").alias("days"))
    earlier = kept.select(*METER_KEY, "date_local", "total_kwh", sum_before.alias("_before"), F.lit(True).alias(CONTEXT))
    both = measures.withColumn(CONTEXT, F.lit(False)).unionByName(earlier, allowMissingColumns=True)
    added = (
        add_cumulative(both, "_before").transform(add_rolling_aggregates_daily, options.rolling_days)
        .where(~F.col(CONTEXT)).drop(CONTEXT, "_before")
        .transform(add_season_and_holiday_flags, options.holidays)
        .transform(categorize_daily_consumption, options.bins, options.labels)
        .withColumn(STORED_MONTH, _month_key("date_local"))
    )
    # The months of new hours, as the folders just written tell; a day without any new hour doesn't change.
    months = {str(int(year) * 100 + int(month)) for year, month in
              (re.findall(r"=(\d+)", versions.partition_of(f)) for f in new_hours if "__HIVE" not in f)}
    again = [f for f in before.folders[DAILY_TABLE] if versions.partition_of(f).removeprefix(f"{STORED_MONTH}=") in months]
    old = versions.open_folders(run.spark, run.root, DAILY_TABLE, again)
    if old is not None:
        # The last stored day may lack the hours that the new days bring; it is among the rows computed anew.
        stay = old.join(first_day, METER_KEY, "left").where("_first IS NULL OR date_local < _first")
        added = added.unionByName(stay.select(*added.columns))
    daily = run.write(added, DAILY_TABLE)
    run.folders[DAILY_TABLE] = versions.replaced(before.folders[DAILY_TABLE], run.folders[DAILY_TABLE])
    run.write(derive_monthly_from_daily(daily), MONTHLY_TABLE)
    run.folders[MONTHLY_TABLE] = versions.replaced(before.folders[MONTHLY_TABLE], run.folders[MONTHLY_TABLE])

    others = old_totals.join(first_day, METER_KEY, "left").where("_first IS NULL OR date_local < _first")
    fresh = daily.join(first_day, METER_KEY).where("date_local >= _first").withColumnRenamed("cumulative_total_kwh", "running_total")
    run.write(last_totals(others.select(*METER_KEY, *DAY_COLUMNS).unionByName(fresh.select(*METER_KEY, *DAY_COLUMNS)), options), TOTALS_TABLE)
    run.write(last_days(new.unionByName(old_days.select(*new.columns)), options), LAST_DAYS_TABLE)
    return counts.checked(plain, run.rows[HOURLY_TABLE])


def compact(spark: SparkSession, root: str, most: int = 8) -> versions.Manifest | None:
    """Write the months of hours that lie in more than ``most`` folders, one for each run that added to them, into one each.

    The rows stay the same and so do the other tables; None where no month has so many folders.  The old folders stay for readers that
    have them open, until ``versions.drop_unreferenced``.
    """
    before = versions.current(spark, root)
    hours = list(before.folders[HOURLY_TABLE]) if before else []
    count = Counter(map(versions.partition_of, hours))
    parts = [f for f in hours if count[versions.partition_of(f)] > most]
    if not parts:
        return None
    run = Run(spark, root, Options(), before)
    run.write(versions.open_folders(spark, root, HOURLY_TABLE, parts), HOURLY_TABLE)
    folders = {**before.folders, HOURLY_TABLE: versions.replaced(hours, run.folders[HOURLY_TABLE])}
    return versions.publish(spark, root, before, folders, before.options)
