"""Meter-days derived from the ``events`` table.

Ten users form a meter and ten meters a client.  The 30 days of events are moved
by one of four distances, so that the meters together see both clock changes,
all seasons, holidays and a change of year.  A reading is the sum of the hour's
values in whole numbers, null without events.  The 13th day of every fifth meter
loses its last reading and must be rejected.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.settings import HOURS_PER_DAY

DAY_SHIFTS = (70, 160, 280, 340)
BINS = (-1.0, 600.0, 1000.0, 1500.0, 999999.0)


def meter_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    meter = F.floor(F.col("user_id") / 10)
    moved = F.date_add(F.to_date("ts"), F.element_at(
        F.array(*map(F.lit, DAY_SHIFTS)), (meter % 4 + 1).cast("int")))
    whole = F.round("value").cast("bigint")
    days = (
        events.select(meter.alias("meter"), moved.alias("date"), F.hour("ts").alias("h"), whole.alias("v"))
        .groupBy("meter", "date")
        .agg(F.array(*[F.sum(F.when(F.col("h") == h, F.col("v")))
                       for h in range(HOURS_PER_DAY)]).alias("readings"))
    )
    short = (F.dayofmonth("date") == 13) & (F.col("meter") % 5 == 0)
    return days.select(
        F.concat(F.lit("client_"), F.floor(F.col("meter") / 10)).alias("client_id"),
        "date",
        F.concat(F.lit("dev_"), F.col("meter")).alias("ext_dev_ref"),
        F.when(short, F.slice("readings", 1, HOURS_PER_DAY - 1))
        .otherwise(F.col("readings")).alias("energy_consumption"),
        F.lit("PT1H").alias("resolution"),
    )
