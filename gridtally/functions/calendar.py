"""Seasons, school vacation and Lithuanian public holidays."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The months of each season and the vacation months.
SEASON_BY_MONTH = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "fall": (9, 10, 11),
}
VACATION_MONTHS = (7, 8)

# Holidays on a fixed date as (month, day, first year).
FIXED_HOLIDAYS = (
    (1, 1, 1990),
    (2, 16, 1990),
    (3, 11, 1990),
    (5, 1, 1990),
    (6, 24, 2003),
    (7, 6, 1991),
    (8, 15, 1990),
    (11, 1, 1990),
    (11, 2, 2020),
    (12, 24, 1990),
    (12, 25, 1990),
    (12, 26, 1990),
)
# Months whose first Sunday is a holiday (mothers' and fathers' day).
FIRST_SUNDAY_MONTHS = (5, 6)

# Fixed value: the year from which the calendar is known.  Earlier dates are no holidays.
FIRST_YEAR = 1990


def season(month: Column) -> Column:
    chosen = F.lit(None).cast("string")
    for name, months in SEASON_BY_MONTH.items():
        chosen = F.when(month.isin(*months), F.lit(name)).otherwise(chosen)
    return chosen


def is_summer_vacation(month: Column) -> Column:
    return month.isin(*VACATION_MONTHS).cast("int")


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous (Meeus/Jones/Butcher) rule, in whole numbers."""
    div = lambda a, b: F.floor(a / b)
    golden = year % 19
    century, in_century = div(year, 100), year % 100
    moon_shift = div(century - div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - div(century, 4) - moon_shift + 15) % 30
    to_sunday = (century % 4 * 2 + div(in_century, 4) * 2 - epact - in_century % 4 + 32) % 7
    late = div(golden + epact * 11 + to_sunday * 22, 451)
    from_march = epact + to_sunday - late * 7 + 114
    return F.make_date(year, div(from_march, 31).cast("int"), (from_march % 31 + 1).cast("int"))


def is_holiday(day: Column) -> Column:
    """Whether a date is a public holiday of Lithuania, for any year from FIRST_YEAR on."""
    year, month, of_month = F.year(day), F.month(day), F.dayofmonth(day)
    fixed = [(month == m) & (of_month == d) & (year >= since) for m, d, since in FIXED_HOLIDAYS]
    sunday = (F.weekday(day) == 6) & (of_month <= 7) & month.isin(*FIRST_SUNDAY_MONTHS)
    # Easter falls between 22 March and 25 April, so that other months need no computing.
    easter = F.when(month.isin(3, 4), F.date_diff(day, easter_sunday(year)).isin(0, 1)).otherwise(False)
    found = sunday | easter
    for one in fixed:
        found = found | one
    return F.coalesce(found & (year >= FIRST_YEAR), F.lit(False))


def holiday_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """The public holidays of some years, one ``holiday_date`` per row."""
    days = F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))))
    return (
        spark.range(first_year, last_year + 1)
        .select(F.col("id").cast("int").alias("year")).select(days.alias("holiday_date"))
        .where(is_holiday(F.col("holiday_date")))
    )
