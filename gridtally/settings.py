"""Defaults shared by the steps and jobs."""

# Zone of the meters and names of the stored tables.
LOCAL_TZNAME = "Europe/Vilnius"
HOURLY_TABLE = "meter_hourly"
DAILY_TABLE = "meter_daily"
DAILY_ROLLING_VIEW = "meter_daily_rolling_7d"
MONTHLY_TABLE = "meter_monthly"
REJECTS_TABLE = "meter_rejects"
# Hourly rows without columns that look back, where tables are built on demand and not stored.
PLAIN_HOURS = "plain_hours"
# What the next run goes on from: the last meter-days of every meter, and its last days with what they add up to.
LAST_DAYS_TABLE = "meter_last_days"
TOTALS_TABLE = "meter_totals"

HOURS_PER_DAY = 24

# Rows that must be seen in order are cut into slices of about this many (operators/lookback.py).
# A million hourly rows are 114 years of one meter.
MAX_ROWS_PER_SLICE = 1_000_000

# Meter-days in one task of the hourly table: some 10 MB of arrays before the expansion.
MAX_DAYS_PER_TASK = 50_000

# Copies of one meter's date that stay together where days are dealt out in order.
MAX_COPIES_PER_TASK = 10_000

# Rows in one file of a stored table.
MAX_ROWS_PER_FILE = 10_000_000

# Meters in one row group that a Bloom filter of 1 % false hits is sized for: some 60 KB a row group.
LOOKUP_VALUES = 50_000
