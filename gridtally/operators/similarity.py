"""How alike the load shapes of a meter's consecutive days are."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.functions.readings import cosine, norm, reading
from gridtally.settings import HOURS_PER_DAY


def day_load_vectors(df_hourly: DataFrame) -> DataFrame:
    """24 mean readings per meter and date, 0 for an hour without one; days without
    any reading are absent."""
    means = [
        F.coalesce(F.expr(f"avg(kwh) FILTER (WHERE hour = {h})"), F.lit(0.0))
        for h in range(HOURS_PER_DAY)
    ]
    return (
        df_hourly.select("ext_dev_ref", "date_local", "hour", reading(df_hourly).alias("kwh"))
        .dropna(subset=["ext_dev_ref", "date_local", "kwh"])
        .groupBy("ext_dev_ref", "date_local")
        .agg(F.array(*means).alias("load"))
    )


def daily_load_similarity(df_hourly: DataFrame) -> DataFrame:
    """Cosine of each day's load vector and that of the meter's previous present day;
    null for the first day."""
    # One row per calendar date of a meter: a small group.
    by_day = Window.partitionBy("ext_dev_ref").orderBy("date_local")
    vectors = day_load_vectors(df_hourly).withColumn("norm", norm(F.col("load")))
    pairs = vectors.withColumns({
        "earlier": F.lag("load").over(by_day),
        "earlier_norm": F.lag("norm").over(by_day),
    })
    alike = cosine(F.col("earlier"), F.col("earlier_norm"), F.col("load"), F.col("norm"))
    return pairs.select(
        "ext_dev_ref", "date_local",
        F.when(F.col("earlier").isNotNull(), alike).alias("daily_load_similarity"),
    )


def add_daily_load_shape_similarity(df_hourly: DataFrame, df_daily: DataFrame) -> DataFrame:
    """Add ``daily_load_similarity`` to the daily rows, matched by meter and date."""
    columns = [*df_daily.columns, "daily_load_similarity"]
    return df_daily.join(
        daily_load_similarity(df_hourly), ["ext_dev_ref", "date_local"], "left").select(*columns)
