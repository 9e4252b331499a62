"""Lags and rolling statistics over the previous rows of a meter.

A meter's rows are ordered by (timestamp, timestamp_local, row id) and every
feature of a row looks back at most ``depth`` rows.  All meters are cut into
slices in the same way, by the number of rows that stand before a day: a slice
begins where a multiple of the limit is passed, and a day that alone exceeds the
limit is cut further, by instant and by ranges of the row id.  An ordinary meter
comes out as one slice.  Every slice gets the ``depth`` rows that stand before
it, so that slicing changes no value.  The counts are joined by shuffle; nothing
is broadcast and no meter is left out.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridtally.functions.readings import reading
from gridtally.settings import MAX_ROWS_PER_SLICE
from gridtally.sources.meter_days import SOURCE_ROW

METER = "ext_dev_ref"
VALUE = "consumption_kwh"
ROW = "_row"
SPREAD = "_spread"
DAY = "_cut_day"
SLICE = "_slice"
PARTS = "_parts"
CUT = "_cut"
_FINE = ["_slice_time", "_slice_local", "_slice_part"]
#: A slice is a window group of its own.
SLICE_KEY = [METER, SPREAD, SLICE, *_FINE]


@dataclass(frozen=True)
class Lookback:
    """Which features to add: lags and one rolling window, both in rows."""

    lags: Sequence[int] = ()
    window_hours: int | None = None

    def __post_init__(self):
        if any(lag < 0 for lag in self.lags):
            raise ValueError("lags must not be negative")
        if self.window_hours is not None and self.window_hours < 1:
            raise ValueError("window_hours must be positive")

    @property
    def depth(self) -> int:
        return max([*self.lags, self.window_hours or 0, 1])

    def columns(self, ordered: WindowSpec) -> dict[str, Column]:
        """Feature columns over ``ordered``; null for rows without a meter."""
        value = F.col(VALUE)
        found = {f"lag_{n}h": F.lag(value, n).over(ordered) for n in self.lags}
        if self.window_hours is not None:
            n = self.window_hours
            previous = ordered.rowsBetween(-n, -1)
            found[f"rolling_mean_{n}h"] = F.avg(value).over(previous)
            found[f"rolling_std_{n}h"] = F.coalesce(
                F.stddev_samp(value).over(previous), F.lit(0.0))
        return {name: F.when(F.col(METER).isNotNull(), c) for name, c in found.items()}


def with_row_id(df: DataFrame) -> DataFrame:
    """Add the tie-break ``_row`` and ``_spread``, which makes each row without a
    meter a group of its own instead of sending all of them to one task.

    The id is a hash of the row's place in the store.  Without that it is one of the
    values and of the row's number in the frame, so that equal copies differ too.
    """
    if ROW in df.columns:
        return df
    row = F.xxhash64(SOURCE_ROW) if SOURCE_ROW in df.columns else F.xxhash64(
        *df.columns, F.monotonically_increasing_id())
    return df.withColumn(ROW, row).withColumn(
        SPREAD, F.when(F.col(METER).isNull(), F.col(ROW)).otherwise(F.lit(0).cast("bigint")))


def slice_days(days: DataFrame, limit: int = MAX_ROWS_PER_SLICE) -> DataFrame:
    """(meter, spread, day, slice, parts) for the days of meters with more than ``limit`` rows.

    ``days`` has a count ``n`` for (meter, spread, day).  A slice holds at most ``limit`` rows and one day more; a day of
    more than ``limit`` has ``parts`` above 1.  A window here sees one row per day of a meter.
    """
    of_meter = Window.partitionBy(METER, SPREAD)
    before = F.coalesce(F.sum("n").over(of_meter.orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        days.withColumns({"_before": before, "_all": F.sum("n").over(of_meter)})
        .where(F.col("_all") > limit)
        .select(METER, SPREAD, DAY, F.floor(F.col("_before") / limit).alias(SLICE),
                F.ceil(F.col("n") / limit).alias(PARTS))
    )


def with_slices(rows: DataFrame, slices: DataFrame) -> DataFrame:
    """``rows`` with their slice, all 0 where a meter is not cut."""
    joined = rows.join(slices, [METER, SPREAD, DAY], "left").select(*rows.columns, SLICE, PARTS)
    return joined.withColumns({
        CUT: F.col(SLICE).isNotNull(),
        SLICE: F.coalesce(SLICE, F.lit(0)),
        PARTS: F.coalesce(PARTS, F.lit(1)),
    })


def _order(df: DataFrame, ts_col: str) -> list[str]:
    local = ["timestamp_local"] if "timestamp_local" in df.columns and ts_col != "timestamp_local" else []
    return [ts_col, *local]


def with_slice_key(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Add what tells the slices of a crowded day apart, so that SLICE_KEY is complete."""
    instant = _order(df, ts_col)
    crowded = F.col(PARTS) > 1
    # Row ids are spread evenly over the 64-bit range: equal parts of the range hold
    # about equally many rows and keep the order of the ids.
    part = F.floor((F.col(ROW) / F.lit(2.0**64) + 0.5) * F.col(PARTS))
    return df.withColumns({
        "_slice_time": F.when(crowded, F.col(instant[0])),
        "_slice_local": F.when(crowded, F.col(instant[-1])),
        "_slice_part": F.when(crowded, part).otherwise(F.lit(0)),
    })


def sliced_lookback(df: DataFrame, lookback: Lookback, ts_col: str = "timestamp", cut: DataFrame | None = None,
                    partitions: int | None = None) -> DataFrame:
    """The features, from rows that know their slice.

    ``cut`` are the rows of meters with several slices, if they can be had for less than a filter of ``df``.  Of
    these one window per meter sees the last ``depth`` rows of each slice, so about depth / limit of the rows.
    ``partitions`` says that ``df`` lies in so many partitions by (meter, spread, slice); what is carried
    over joins them there, and the rows of ``df`` stay where they are.
    """
    instant = _order(df, ts_col)
    depth = lookback.depth
    sliced = with_slice_key(df, ts_col)
    cut = sliced.where(CUT) if cut is None else with_slice_key(cut, ts_col)

    from_end = Window.partitionBy(*SLICE_KEY).orderBy(*[F.desc(c) for c in instant], F.desc(ROW))
    tails = (
        cut.select(*dict.fromkeys([*SLICE_KEY, *instant, ROW, VALUE]))
        .withColumn("_from_end", F.row_number().over(from_end))
        .where(F.col("_from_end") <= depth)
    )
    place = F.struct(SLICE, *_FINE)
    by_meter = Window.partitionBy(METER, SPREAD).orderBy(SLICE, *_FINE, *instant, ROW)
    # Rows before a slice are numbered up to -1, the slice's own rows are all 0.
    numbered = lambda row, i: F.struct((i - depth - 1).alias("_seq"), row[VALUE].alias(VALUE))
    before = (
        tails.select(
            *SLICE_KEY,
            (~F.lag(place).over(by_meter).eqNullSafe(place)).alias("_starts"),
            F.collect_list(F.struct(F.col(VALUE))).over(by_meter.rowsBetween(-depth, -1)).alias("_before"),
        )
        .where("_starts")
        .select(*SLICE_KEY, F.explode(F.transform("_before", numbered)).alias("_earlier"))
        .select(*SLICE_KEY, "_earlier._seq", f"_earlier.{VALUE}")
    )
    if partitions is not None:
        before = before.repartition(partitions, METER, SPREAD, SLICE)
    ordered = Window.partitionBy(*SLICE_KEY).orderBy("_seq", *instant, ROW)
    return (
        sliced.withColumn("_seq", F.lit(0))
        .unionByName(before, allowMissingColumns=True)
        .withColumns(lookback.columns(ordered))
        .where(F.col("_seq") == 0)
        .drop("_seq", SLICE, PARTS, CUT, DAY, *_FINE)
    )


def add_lookback_features(df: DataFrame, lookback: Lookback, ts_col: str = "timestamp",
                          limit: int = MAX_ROWS_PER_SLICE) -> DataFrame:
    """Cut the meters into slices of about ``limit`` rows and add the features."""
    if ts_col not in df.columns:
        raise KeyError(f"{ts_col} is required")
    # Rows without a time come first, as a day of their own.
    day = F.coalesce(F.to_date(F.col(ts_col).try_cast("timestamp_ntz")), F.to_date(F.lit("0001-01-01")))
    rows = with_row_id(df.withColumn(VALUE, reading(df, VALUE))).withColumn(DAY, day)
    counts = (rows.where(F.col(METER).isNotNull()).groupBy(METER, DAY).agg(F.count("*").alias("n"))
              .withColumn(SPREAD, F.lit(0).cast("bigint")))
    sliced = with_slices(rows, slice_days(counts, limit))
    return sliced_lookback(sliced, lookback, ts_col).drop(ROW, SPREAD)


def add_lag_features(df: DataFrame, lags: Sequence[int] = (1, 24), ts_col: str = "timestamp",
                     limit: int = MAX_ROWS_PER_SLICE) -> DataFrame:
    """Add ``lag_{n}h``: the reading n rows earlier of the same meter."""
    return add_lookback_features(df, Lookback(lags=tuple(lags)), ts_col, limit)


def add_rolling_features_hourly(df: DataFrame, window_hours: int = 24, ts_col: str = "timestamp",
                                limit: int = MAX_ROWS_PER_SLICE) -> DataFrame:
    """Add mean and sample deviation of the previous ``window_hours`` rows, the current
    row left out: ``rolling_mean_{n}h`` (null without a reading) and ``rolling_std_{n}h``
    (0 with fewer than two)."""
    return add_lookback_features(df, Lookback(window_hours=window_hours), ts_col, limit)
