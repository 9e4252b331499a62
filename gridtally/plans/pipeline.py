"""From meter-days to the three tables."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridtally.functions import times
from gridtally.functions.readings import DEFAULT_BINS, DEFAULT_LABELS
from gridtally.operators.daily import (
    add_rolling_aggregates_daily,
    add_season_and_holiday_flags,
    aggregate_daily_from_hourly,
    categorize_daily_consumption,
)
from gridtally.operators.expand import check_columns, expand_daily_array_to_hourly
from gridtally.operators.hourly import set_calendar
from gridtally.operators.lookback import (
    CUT,
    DAY,
    METER,
    PARTS,
    ROW,
    SLICE,
    SPREAD,
    Lookback,
    slice_days,
    sliced_lookback,
    with_row_id,
    with_slices,
)
from gridtally.operators.monthly import derive_monthly_from_daily
from gridtally.settings import (
    DAILY_ROLLING_VIEW,
    DAILY_TABLE,
    HOURLY_TABLE,
    HOURS_PER_DAY,
    LOCAL_TZNAME,
    MAX_DAYS_PER_TASK,
    MAX_ROWS_PER_SLICE,
    MONTHLY_TABLE,
    PLAIN_HOURS,
)


@dataclass(frozen=True)
class Options:
    """Parameters of the pipeline and their defaults."""

    date_col: str = "date"
    arr_col: str = "energy_consumption"
    timezone: str = LOCAL_TZNAME
    calendar: str = "utc"
    lags: Sequence[int] = (1, 24)
    window_hours: int = 24
    rolling_days: Sequence[int] = (7, 30)
    bins: Sequence[float] = DEFAULT_BINS
    labels: Sequence[str] = DEFAULT_LABELS
    holidays: DataFrame | None = field(default=None, compare=False)
    max_rows_per_slice: int = MAX_ROWS_PER_SLICE
    hourly_partitions: int | None = None  # default: by the number of meter-days, see hourly_partitions()


def raw_hours(raw: DataFrame, options: Options = Options()) -> DataFrame:
    """The hourly rows before any feature; date and hour are those of the input."""
    return expand_daily_array_to_hourly(raw, options.date_col, options.arr_col, options.timezone)


def hours_with_time(raw: DataFrame, options: Options = Options(), keep: Sequence[str] = ()) -> DataFrame:
    hours = expand_daily_array_to_hourly(
        raw, options.date_col, options.arr_col, options.timezone, keep, utc_col="_utc")
    return set_calendar(hours, F.col("_utc"), options.timezone, options.calendar).drop("_utc")


def hourly_partitions(meter_days: int, session_default: int) -> int:
    """Partitions of the hourly shuffle: as many as the input needs, and not fewer than the session's default."""
    return max(session_default, -(-meter_days // MAX_DAYS_PER_TASK))


def hourly_table(raw: DataFrame, options: Options = Options(),
                 meters: DataFrame | None = None, keep: Sequence[str] = (),
                 seen: tuple[Observation, Sequence[Column]] | None = None) -> DataFrame:
    """Hourly rows with all features, and the input columns named in ``keep``.  ``seen`` are aggregates of the meter-days
    to take on the way, where they are read to be shuffled.

    The meter-days are cut into slices and shuffled by them before they are expanded: an
    array of 24 numbers instead of 24 wide rows.  The window that follows reuses that
    partitioning.  The number of partitions is given, because an adaptive plan would join
    partitions by the size of the arrays, which grow twentyfold in the same task.

    The hours of a day follow those of the day before, so that slices of local days are
    runs of rows.  ``meters`` may be the same meter-days read without row places, so that
    counting reads two columns and nothing else.
    """
    check_columns(raw, options.date_col, options.arr_col)
    lookback = Lookback(tuple(options.lags), options.window_hours)
    day = lambda df: F.coalesce(times.to_day(df, options.date_col), F.to_date(F.lit("0001-01-01")))
    counted = raw if meters is None else meters
    counts = (
        counted.where(F.col(METER).isNotNull()).withColumn(DAY, day(counted))
        .groupBy(METER, DAY).agg((F.count("*") * HOURS_PER_DAY).alias("n"))
        .withColumn(SPREAD, F.lit(0).cast("bigint")))
    slices = slice_days(counts, options.max_rows_per_slice)
    rows = with_row_id(raw).withColumn(DAY, day(raw))
    partitions = options.hourly_partitions or hourly_partitions(
        0, int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = with_slices(rows, slices)
    if seen is not None:
        dealt = dealt.observe(seen[0], *seen[1])
    dealt = dealt.repartition(partitions, METER, SPREAD, SLICE)
    # Meters with several slices once more, for the rows that carry over; without any, Spark
    # finds this side empty and drops it.
    again = rows.join(slices, [METER, SPREAD, DAY]).withColumn(CUT, F.lit(True))

    keep = [ROW, SPREAD, DAY, SLICE, PARTS, CUT, *keep]
    hours = sliced_lookback(hours_with_time(dealt, options, keep), lookback,
                            cut=hours_with_time(again, options, keep), partitions=partitions)
    return hours.drop(ROW, SPREAD)


def daily_table(raw: DataFrame, options: Options = Options()) -> DataFrame:
    """Daily rows with all measures, flags, rolling means and the band.

    Built from the meter-days, not from the wider hourly table: hours are summed up
    to days before they are shuffled.
    """
    return (
        aggregate_daily_from_hourly(hours_with_time(raw, options))
        .transform(add_season_and_holiday_flags, options.holidays)
        .transform(add_rolling_aggregates_daily, options.rolling_days)
        .transform(categorize_daily_consumption, options.bins, options.labels)
    )


class BuiltTables(Mapping):
    """The tables as frames of one lineage, nothing stored; each is built when asked for."""

    def __init__(self, raw: DataFrame, options: Options = Options()):
        self._frames: dict[str, DataFrame] = {}
        self._builders = {
            HOURLY_TABLE: lambda: hourly_table(raw, options),
            DAILY_TABLE: lambda: daily_table(raw, options),
            DAILY_ROLLING_VIEW: lambda: self[DAILY_TABLE],
            MONTHLY_TABLE: lambda: derive_monthly_from_daily(self[DAILY_TABLE]),
        }
        self._plain = lambda: hours_with_time(raw, options)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._plain() if name == PLAIN_HOURS else self._builders[name]()
        return self._frames[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
