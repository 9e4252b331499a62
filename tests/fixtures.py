"""Meter-days of the tests (FIXTURES.md)."""

import datetime

from gridtally.schemas import METER_DAYS


def dates(first: str, n: int) -> list[datetime.date]:
    start = datetime.date.fromisoformat(first)
    return [start + datetime.timedelta(days=i) for i in range(n)]


def meter_days(spark, rows):
    """Rows as (client, date text, meter, readings) or with a resolution."""
    full = [
        (c, datetime.date.fromisoformat(d) if isinstance(d, str) else d, m, a, *(rest or ("PT1H",)))
        for c, d, m, a, *rest in rows
    ]
    return spark.createDataFrame(full, METER_DAYS)


def golden_year(spark):
    rows = []
    for day in dates("2022-01-01", 365):
        readings = [100] * 24
        if day == datetime.date(2022, 3, 27):
            readings[3] = None
        if day == datetime.date(2022, 10, 30):
            readings[3] = 200
        rows.append(("111111", day, "ext_device_1", readings))
    return meter_days(spark, rows)


def two_meters_ramp(spark):
    rows = []
    for client in (1, 2):
        for m in (1, 2):
            meter = 2 * (client - 1) + m
            for i, day in enumerate(dates("2023-05-01", 40)):
                rows.append((f"c{client}", day, f"m{meter}", [10 * meter + h + i for h in range(24)]))
    return meter_days(spark, rows)


def dst_week(spark):
    rows = []
    for k, first in enumerate(("2022-03-25", "2022-10-28")):
        for i, day in enumerate(dates(first, 5)):
            rows.append(("c", day, "m", [1000 * k + 100 * i + h for h in range(24)]))
    return meter_days(spark, rows)
