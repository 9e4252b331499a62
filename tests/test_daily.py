"""Daily and monthly measures, calendar, bands, similarity and reports on small fixtures."""

import datetime
import math

import pytest
from fixtures import golden_year, meter_days, two_meters_ramp
from pyspark.sql import functions as F

from gridtally.functions.calendar import holiday_calendar
from gridtally.operators.daily import (
    add_rolling_aggregates_daily,
    add_season_and_holiday_flags,
    aggregate_daily_from_hourly,
    aggregate_daily_measures,
    categorize_daily_consumption,
)
from gridtally.operators.monthly import derive_monthly_from_daily
from gridtally.operators.similarity import add_daily_load_shape_similarity, daily_load_similarity
from gridtally.plans.pipeline import BuiltTables, Options, daily_table, hours_with_time
from gridtally.plans.reports import similar_meters, top_meters_by_year
from gridtally.schemas import DAILY, MONTHLY

HOUR_ROWS = "client_id string, ext_dev_ref string, date_local date, hour int, consumption_kwh double"


def hours(spark, values, client="c", meter="m", day="2022-05-02"):
    return spark.createDataFrame(
        [(client, meter, datetime.date.fromisoformat(day), h, v) for h, v in values], HOUR_ROWS)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_measures(spark):
    r = one(aggregate_daily_from_hourly(hours(spark, [(0, 1.0), (6, 2.0), (7, 4.0), (17, 8.0), (18, 16.0), (23, None)])))
    assert (r.total_kwh, r.mean_kwh, r.max_kwh, r.hourly_count) == (31.0, 6.2, 16.0, 5)
    assert r.std_kwh == pytest.approx(6.099180272790763)
    assert (r.peak_hour, r.peak_kwh) == (18, 16.0)
    assert r.peak_to_mean_ratio == pytest.approx(16 / 6.2)
    assert (r.night_kwh, r.day_kwh, r.cumulative_total_kwh) == (3.0, 16.0, 31.0)
    assert r.weekend_vs_weekday == pytest.approx(31 / (31 + 1e-6))


def test_peak_tie_takes_the_first_hour(spark):
    r = one(aggregate_daily_measures(hours(spark, [(20, 5.0), (3, 5.0), (9, 5.0), (1, 4.0)])))
    assert (r.peak_hour, r.peak_kwh) == (3, 5.0)


def test_negative_peak(spark):
    r = one(aggregate_daily_measures(hours(spark, [(4, -5.0), (5, -2.0), (6, -2.0)])))
    assert (r.peak_hour, r.peak_kwh, r.peak_to_mean_ratio) == (5, -2.0, pytest.approx(2 / 3))


def test_all_null_day_is_kept(spark):
    r = one(aggregate_daily_measures(hours(spark, [(h, None) for h in range(24)])))
    assert (r.total_kwh, r.mean_kwh, r.max_kwh, r.std_kwh, r.hourly_count) == (0.0, None, None, None, 0)
    assert (r.peak_hour, r.peak_kwh, r.peak_to_mean_ratio, r.night_kwh, r.day_kwh) == (None, None, 0.0, 0.0, 0.0)


def test_all_zero_day(spark):
    r = one(aggregate_daily_measures(hours(spark, [(h, 0.0) for h in range(24)])))
    assert (r.peak_hour, r.peak_kwh, r.peak_to_mean_ratio, r.std_kwh) == (0, 0.0, 0.0, 0.0)


def test_single_and_nan_readings(spark):
    r = one(aggregate_daily_measures(hours(spark, [(2, 7.0), (3, float("nan"))])))
    assert (r.total_kwh, r.std_kwh, r.hourly_count, r.peak_hour) == (7.0, None, 1, 2)


def test_null_keys_are_left_out(spark):
    df = hours(spark, [(1, 1.0)], client=None).union(hours(spark, [(1, 1.0)], meter=None)).union(
        hours(spark, [(1, 3.0)]))
    assert one(aggregate_daily_measures(df)).total_kwh == 3.0


def test_date_from_timestamp(spark):
    df = hours(spark, [(1, 1.0)]).withColumn("timestamp", F.expr("TIMESTAMP_NTZ'2022-05-02 01:00:00'"))
    assert str(one(aggregate_daily_measures(df.drop("date_local"))).date_local) == "2022-05-02"
    with pytest.raises(KeyError):
        aggregate_daily_measures(df.drop("date_local", "timestamp"))


def test_running_and_rolling(spark):
    raw = two_meters_ramp(spark)
    days = daily_table(raw).where("client_id = 'c1' AND ext_dev_ref = 'm2'").orderBy("date_local").collect()
    assert len(days) == 41
    totals = [r.total_kwh for r in days]
    for i, r in enumerate(days):
        assert r.cumulative_total_kwh == pytest.approx(sum(totals[:i + 1]))
        assert r.weekend_vs_weekday == pytest.approx(r.total_kwh / (sum(totals) / len(totals) + 1e-6))
        for n, got in ((7, r.rolling_7d_total_kwh), (30, r.rolling_30d_total_kwh)):
            last = totals[max(0, i + 1 - n):i + 1]
            assert got == pytest.approx(sum(last) / len(last), abs=1e-6)


def test_rolling_parameters(spark):
    days = aggregate_daily_measures(hours_with_time(two_meters_ramp(spark)))
    assert add_rolling_aggregates_daily(days, [3]).columns[-1] == "rolling_3d_total_kwh"
    with pytest.raises(KeyError):
        add_rolling_aggregates_daily(days.drop("date_local"))


def day_rows(spark, totals):
    rows = [("c", "m", datetime.date(2022, 5, 1) + datetime.timedelta(days=i), float(t) if t is not None else None)
            for i, t in enumerate(totals)]
    return spark.createDataFrame(rows, "client_id string, ext_dev_ref string, date_local date, total_kwh double")


def test_band_edges(spark):
    totals = [-1, -0.5, 0, 5, 5.5, 15, 16, 50, 51, 999999, 1000000, None]
    got = [r.consumption_category for r in
           categorize_daily_consumption(day_rows(spark, totals)).orderBy("date_local").collect()]
    assert got == [None, "very_low", "very_low", "very_low", "low", "low", "medium", "medium", "high", "high", None, None]


def test_band_parameters(spark):
    df = day_rows(spark, [1, 10])
    got = categorize_daily_consumption(df, bins=[0, 5, 20], labels=["a", "b"]).orderBy("date_local").collect()
    assert [r.consumption_category for r in got] == ["a", "b"]
    for bins, labels in (([0, 5], ["a", "b"]), ([5, 0], ["a"])):
        with pytest.raises(ValueError):
            categorize_daily_consumption(df, bins, labels)


def test_holidays_of_a_year(spark):
    days = {str(r.holiday_date) for r in holiday_calendar(spark, 2022, 2022).collect()}
    assert days == {
        "2022-01-01", "2022-02-16", "2022-03-11", "2022-04-17", "2022-04-18", "2022-05-01", "2022-06-05",
        "2022-06-24", "2022-07-06", "2022-08-15", "2022-11-01", "2022-11-02", "2022-12-24", "2022-12-25",
        "2022-12-26",
    }


def test_first_years_of_holidays(spark):
    days = {str(r.holiday_date) for r in holiday_calendar(spark, 1980, 2110).collect()}
    assert min(days) == "1990-01-01"
    assert {"2101-12-25", "2101-04-17", "2101-01-01"} <= days
    for date, known in (("1990-07-06", False), ("1991-07-06", True), ("2002-06-24", False), ("2003-06-24", True),
                        ("2019-11-02", False), ("2020-11-02", True), ("2024-05-05", True), ("2025-06-01", True)):
        assert (date in days) == known, date


def test_easter(spark):
    days = {str(r.holiday_date) for r in holiday_calendar(spark, 1990, 2100).collect()}
    for sunday in ("1990-04-15", "2000-04-23", "2008-03-23", "2011-04-24", "2024-03-31", "2025-04-20",
                   "2038-04-25", "2049-04-18", "2076-04-19", "2100-03-28"):
        monday = datetime.date.fromisoformat(sunday) + datetime.timedelta(days=1)
        assert {sunday, str(monday)} <= days


def test_holidays_need_no_calendar_of_years(spark):
    rows = [(datetime.date(y, 12, 25),) for y in (1989, 1990, 2100, 2101, 2500)] + [(None,)]
    flagged = add_season_and_holiday_flags(spark.createDataFrame(rows, "date_local date"))
    assert [r.is_holiday for r in flagged.orderBy("date_local").collect()] == [0, 0, 1, 1, 1, 1]
    own = spark.createDataFrame([(datetime.date(1989, 12, 25),)], "holiday_date date")
    flagged = add_season_and_holiday_flags(spark.createDataFrame(rows, "date_local date"), own)
    assert [r.is_holiday for r in flagged.orderBy("date_local").collect()] == [0, 1, 0, 0, 0, 0]


def test_seasons_and_vacation(spark):
    dates = [datetime.date(2022, m, 10) for m in range(1, 13)]
    df = spark.createDataFrame([(d,) for d in dates], "date_local date")
    rows = add_season_and_holiday_flags(df).orderBy("date_local").collect()
    assert [r.season for r in rows] == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]
    assert [r.is_summer_vacation for r in rows] == [0] * 6 + [1, 1] + [0] * 4
    assert [r.is_holiday for r in rows] == [0] * 12


def test_own_holidays(spark):
    df = spark.createDataFrame([(datetime.date(2022, 1, d),) for d in (1, 2, 3)], "date_local date")
    own = spark.createDataFrame([(datetime.date(2022, 1, 2),)] * 2, "holiday_date date")
    rows = add_season_and_holiday_flags(df, own).orderBy("date_local").collect()
    assert [r.is_holiday for r in rows] == [0, 1, 0]


def test_table_schemas(spark):
    tables = BuiltTables(golden_year(spark))
    kinds = lambda schema: [(f.name, f.dataType) for f in schema]
    assert kinds(tables["meter_daily"].schema) == kinds(DAILY)
    assert kinds(tables["meter_monthly"].schema) == kinds(MONTHLY)
    assert set(tables) == {"meter_hourly", "meter_daily", "meter_daily_rolling_7d", "meter_monthly"}


def test_monthly_rounding_is_half_even(spark):
    df = day_rows(spark, [0.0000025])
    assert one(derive_monthly_from_daily(df)).monthly_total_kwh == 0.000002


def test_monthly_leaves_out_null_keys(spark):
    df = day_rows(spark, [1.0]).withColumn("client_id", F.lit(None).cast("string"))
    assert derive_monthly_from_daily(df).isEmpty()


def test_similarity(spark):
    by_day = [
        ("2022-05-01", [(0, 1.0), (1, 0.0)]),
        ("2022-05-02", [(0, 1.0), (1, 1.0)]),
        ("2022-05-03", [(h, None) for h in range(24)]),  # absent
        ("2022-05-04", [(0, 2.0), (1, 2.0)]),
        ("2022-05-06", [(0, 0.0)]),
        ("2022-05-07", [(0, 3.0), (0, 5.0), (2, 3.0)]),  # two readings of one hour: their mean
        ("2022-05-08", [(0, 4.0), (2, 3.0)]),
    ]
    df = None
    for day, values in by_day:
        part = hours(spark, values, day=day)
        df = part if df is None else df.union(part)
    got = {str(r.date_local): r.daily_load_similarity for r in daily_load_similarity(df).collect()}
    assert got.keys() == {d for d, _ in by_day} - {"2022-05-03"}
    assert got["2022-05-01"] is None
    assert got["2022-05-02"] == pytest.approx(1 / math.sqrt(2))
    assert got["2022-05-04"] == pytest.approx(1.0)
    assert (got["2022-05-06"], got["2022-05-07"]) == (0.0, 0.0)
    assert got["2022-05-08"] == pytest.approx(1.0)
    daily = add_daily_load_shape_similarity(df, aggregate_daily_measures(df))
    assert daily.columns[-1] == "daily_load_similarity"
    assert daily.count() == 7


def mean_days(spark, means):
    rows = [("c", meter, datetime.date(2022, 5, 1), float(v)) for meter, v in means]
    return {"meter_daily": spark.createDataFrame(
        rows, "client_id string, ext_dev_ref string, date_local date, total_kwh double")}


def test_similar_meters(spark):
    tables = mean_days(spark, [("a", 100), ("b", 91), ("c", 109), ("d", 111), ("e", 89)])
    assert [r.ext_dev_ref for r in similar_meters(tables).collect()] == ["a", "b", "c"]
    assert [r.ext_dev_ref for r in similar_meters(tables, target_dev_ref="d").collect()] == ["d", "c", "a"]
    assert similar_meters(tables, target_dev_ref="x").isEmpty()


def test_top_meters_is_limited_overall(spark):
    tables = mean_days(spark, [(f"m{i:03}", i % 7) for i in range(150)])
    rows = top_meters_by_year(tables).collect()
    assert len(rows) == 100
    assert [(-r.yearly_kwh, r.ext_dev_ref) for r in rows] == sorted((-r.yearly_kwh, r.ext_dev_ref) for r in rows)


def test_local_calendar_pipeline(spark):
    raw = meter_days(spark, [("c", "2022-01-01", "m", [1] * 24)])
    r = one(daily_table(raw, Options(calendar="local")))
    assert (str(r.date_local), r.total_kwh, r.hourly_count) == ("2022-01-01", 24.0, 24)
