"""Schemas of the input and of the three tables."""

from pyspark.sql import types as T

METER_DAYS = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("ext_dev_ref", T.StringType()),
    T.StructField("energy_consumption", T.ArrayType(T.LongType(), containsNull=True)),
    T.StructField("resolution", T.StringType()),
])

HOURLY_RAW_COLUMNS = [
    "client_id", "ext_dev_ref", "resolution", "date_local", "hour",
    "timestamp_local", "timestamp_utc", "consumption_kwh",
]

HOURLY = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("ext_dev_ref", T.StringType()),
    T.StructField("resolution", T.StringType()),
    T.StructField("date_local", T.DateType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("timestamp_local", T.StringType()),
    T.StructField("timestamp_utc", T.StringType()),
    T.StructField("consumption_kwh", T.DoubleType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("lag_1h", T.DoubleType()),
    T.StructField("lag_24h", T.DoubleType()),
    T.StructField("rolling_mean_24h", T.DoubleType()),
    T.StructField("rolling_std_24h", T.DoubleType()),
])

DAILY = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("ext_dev_ref", T.StringType()),
    T.StructField("date_local", T.DateType()),
    T.StructField("total_kwh", T.DoubleType()),
    T.StructField("mean_kwh", T.DoubleType()),
    T.StructField("max_kwh", T.DoubleType()),
    T.StructField("std_kwh", T.DoubleType()),
    T.StructField("hourly_count", T.LongType()),
    T.StructField("peak_hour", T.IntegerType()),
    T.StructField("peak_kwh", T.DoubleType()),
    T.StructField("peak_to_mean_ratio", T.DoubleType()),
    T.StructField("night_kwh", T.DoubleType()),
    T.StructField("day_kwh", T.DoubleType()),
    T.StructField("cumulative_total_kwh", T.DoubleType()),
    T.StructField("weekend_vs_weekday", T.DoubleType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("season", T.StringType()),
    T.StructField("is_holiday", T.IntegerType()),
    T.StructField("is_summer_vacation", T.IntegerType()),
    T.StructField("rolling_7d_total_kwh", T.DoubleType()),
    T.StructField("rolling_30d_total_kwh", T.DoubleType()),
    T.StructField("consumption_category", T.StringType()),
])

MONTHLY = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("ext_dev_ref", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("monthly_total_kwh", T.DoubleType()),
    T.StructField("monthly_mean_kwh", T.DoubleType()),
    T.StructField("monthly_max_kwh", T.DoubleType()),
    T.StructField("days_with_data", T.LongType()),
])
