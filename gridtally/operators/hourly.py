"""Time features of the hourly rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions import times
from gridtally.settings import LOCAL_TZNAME


def add_time_features_hourly(df: DataFrame, timestamp_col: str = "timestamp_local",
                             timezone: str = LOCAL_TZNAME, calendar: str = "utc") -> DataFrame:
    """Add ``timestamp``, ``day_of_week`` (Monday is 0), ``is_weekend``, ``month`` and
    ``year`` and set ``hour`` and ``date_local`` from the parsed time.

    ``calendar="utc"``, the default, takes them from UTC wall time;
    ``"local"`` takes them from wall time in ``timezone``.  Rows whose time
    does not parse are left out; ``unparsed_timestamps`` gives them.
    """
    if timestamp_col not in df.columns:
        raise KeyError(f"{timestamp_col} is required")
    parsed = df.withColumn("_utc", times.parse_to_utc(df, timestamp_col, timezone))
    known = parsed.where(F.col("_utc").isNotNull())
    return set_calendar(known, F.col("_utc"), timezone, calendar).drop("_utc")


def set_calendar(df: DataFrame, utc: Column, timezone: str = LOCAL_TZNAME,
                 calendar: str = "utc") -> DataFrame:
    """The same features from a naive UTC time that is never null."""
    if calendar not in ("utc", "local"):
        raise ValueError("calendar must be 'utc' or 'local'")
    if calendar == "local":
        utc = F.convert_timezone(F.lit("UTC"), F.lit(timezone), utc)
    ts = F.col("timestamp")
    return df.withColumn("timestamp", utc).withColumns({
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "is_weekend": F.weekday(ts).isin(5, 6).cast("int"),
        "date_local": F.to_date(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    })


def unparsed_timestamps(df: DataFrame, timestamp_col: str = "timestamp_local",
                        timezone: str = LOCAL_TZNAME) -> DataFrame:
    """Rows that ``add_time_features_hourly`` leaves out."""
    return df.where(times.parse_to_utc(df, timestamp_col, timezone).isNull())
