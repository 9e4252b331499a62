"""Days to months."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.operators.daily import METER_KEY, _with_date


def derive_monthly_from_daily(df_daily: DataFrame) -> DataFrame:
    """Total, mean and largest day and number of days per client, meter, year and month."""
    df = _with_date(df_daily)
    day, total = F.to_date("date_local"), F.col("total_kwh")
    to_six = lambda c: F.bround(c.cast("double"), 6)
    return (
        df.dropna(subset=[*METER_KEY, "date_local"])
        .groupBy(*METER_KEY, F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(
            to_six(F.coalesce(F.sum(total), F.lit(0.0))).alias("monthly_total_kwh"),
            to_six(F.avg(total)).alias("monthly_mean_kwh"),
            to_six(F.max(total)).alias("monthly_max_kwh"),
            F.count(total).alias("days_with_data"),
        )
    )
