"""Expansion, time features, parsing, lags and rolling statistics on small fixtures."""

import datetime
import math
import random
import statistics

import pytest
from fixtures import dst_week, golden_year, meter_days, two_meters_ramp
from pyspark.sql import functions as F

from gridtally.operators.expand import expand_daily_array_to_hourly, rejected_meter_days
from gridtally.operators.hourly import add_time_features_hourly, unparsed_timestamps
from gridtally.operators.lookback import (
    DAY,
    METER,
    SLICE_KEY,
    Lookback,
    add_lag_features,
    add_lookback_features,
    add_rolling_features_hourly,
    slice_days,
    with_row_id,
    with_slice_key,
    with_slices,
)
from gridtally.plans.pipeline import Options, hourly_table, hours_with_time
from gridtally.schemas import HOURLY, HOURLY_RAW_COLUMNS, METER_DAYS
from gridtally.sources.meter_days import drop_repeated_meter_days, read_all_parquets


def hourly(df):
    return add_time_features_hourly(expand_daily_array_to_hourly(df))


def test_expand_columns_and_types(spark):
    hours = expand_daily_array_to_hourly(golden_year(spark))
    assert hours.columns == HOURLY_RAW_COLUMNS
    assert dict(hours.dtypes)["consumption_kwh"] == "double"


def test_expand_on_clock_changes(spark, session_zone):
    rows = {r.timestamp_local: r for r in expand_daily_array_to_hourly(dst_week(spark)).collect()}
    spring = rows["2022-03-27T03:00:00+02:00"]
    assert (spring.hour, spring.timestamp_utc, spring.consumption_kwh) == (3, "2022-03-27T01:00:00+00:00", 203.0)
    # The offset of midnight holds for the whole day, so 21:00 UTC occurs twice.
    assert rows["2022-03-27T23:00:00+02:00"].timestamp_utc == "2022-03-27T21:00:00+00:00"
    assert rows["2022-03-28T00:00:00+03:00"].timestamp_utc == "2022-03-27T21:00:00+00:00"
    assert rows["2022-10-30T23:00:00+03:00"].timestamp_utc == "2022-10-30T20:00:00+00:00"
    assert rows["2022-10-31T00:00:00+02:00"].timestamp_utc == "2022-10-30T22:00:00+00:00"


@pytest.mark.parametrize("zone, local, utc", [
    ("Asia/Kolkata", "2022-01-01T05:00:00+05:30", "2021-12-31T23:30:00+00:00"),
    ("America/St_Johns", "2022-01-01T23:00:00-03:30", "2022-01-02T02:30:00+00:00"),
    ("America/Los_Angeles", "2022-07-01T20:00:00-07:00", "2022-07-02T03:00:00+00:00"),
    ("UTC", "2022-07-01T20:00:00+00:00", "2022-07-01T20:00:00+00:00"),
])
def test_expand_in_other_zones(spark, zone, local, utc):
    df = meter_days(spark, [("c", local[:10], "m", list(range(24)))])
    rows = expand_daily_array_to_hourly(df, timezone=zone).where(F.col("timestamp_local") == local).collect()
    assert [r.timestamp_utc for r in rows] == [utc]


def test_expand_needs_columns(spark):
    with pytest.raises(ValueError, match="ext_dev_ref"):
        expand_daily_array_to_hourly(golden_year(spark).drop("ext_dev_ref"))


def test_resolution_is_optional(spark):
    hours = expand_daily_array_to_hourly(golden_year(spark).drop("resolution"))
    assert hours.columns == HOURLY_RAW_COLUMNS
    assert hours.where("resolution IS NOT NULL").isEmpty()


def test_bad_arrays(spark):
    df = meter_days(spark, [
        ("c", "2022-01-01", "none", None),
        ("c", "2022-01-01", "empty", []),
        ("c", "2022-01-01", "short", [1] * 23),
        ("c", "2022-01-01", "long", [1] * 25),
        ("c", "2022-01-01", "good", [1] * 24),
    ])
    assert expand_daily_array_to_hourly(df).groupBy("ext_dev_ref").count().collect() == [("good", 24)]
    rejects = {r.ext_dev_ref: (r.array_size, r.reason) for r in rejected_meter_days(df).collect()}
    assert rejects == {
        "none": (None, "no array"), "empty": (0, "wrong array size"),
        "short": (23, "wrong array size"), "long": (25, "wrong array size"),
    }


def test_all_rejected_gives_empty_tables(spark):
    df = meter_days(spark, [("c", "2022-01-01", "m", [1])])
    hours = hourly_table(df)
    assert hours.isEmpty()
    assert [(f.name, f.dataType) for f in hours.schema] == [(f.name, f.dataType) for f in HOURLY]


@pytest.mark.parametrize("given, kind", [
    ("DATE'2022-03-27'", "date"),
    ("TIMESTAMP_NTZ'2022-03-27 00:00:00'", "timestamp_ntz"),
    ("TIMESTAMP_NTZ'2022-03-27 18:30:00'", "timestamp_ntz"),
    ("TIMESTAMP'2022-03-27T00:30:00Z'", "timestamp"),
    ("'2022-03-27'", "string"),
    ("'2022-03-27T00:00:00'", "string"),
    ("'20220327'", "string"),
    ("'2022/03/27'", "string"),
])
def test_date_types(spark, session_zone, given, kind):
    df = golden_year(spark).limit(1).withColumn("date", F.expr(given))
    assert dict(df.dtypes)["date"] == kind
    assert {r.date_local for r in expand_daily_array_to_hourly(df).collect()} == {"2022-03-27"}


def test_bad_date_text_is_rejected(spark):
    df = golden_year(spark).limit(2).withColumn("date", F.lit("not a date"))
    assert expand_daily_array_to_hourly(df).isEmpty()
    assert {r.reason for r in rejected_meter_days(df).collect()} == {"no date"}


def test_nan_becomes_null(spark):
    readings = F.array(*[F.lit(float("nan"))] * 23, F.lit(1.5))
    df = golden_year(spark).limit(1).withColumn("energy_consumption", readings)
    assert [r.consumption_kwh for r in expand_daily_array_to_hourly(df).orderBy("hour").collect()] == [None] * 23 + [1.5]


def test_calendar_modes(spark, session_zone):
    raw = meter_days(spark, [("c", "2022-01-01", "m", list(range(24)))])
    first = lambda df: df.orderBy("timestamp_local").first()
    utc = first(hourly(raw))
    assert (utc.timestamp, utc.hour, str(utc.date_local), utc.day_of_week, utc.is_weekend, utc.month, utc.year) == (
        datetime.datetime(2021, 12, 31, 22), 22, "2021-12-31", 4, 0, 12, 2021)
    local = first(add_time_features_hourly(expand_daily_array_to_hourly(raw), calendar="local"))
    assert (local.timestamp, local.hour, str(local.date_local), local.day_of_week, local.is_weekend) == (
        datetime.datetime(2022, 1, 1, 0), 0, "2022-01-01", 5, 1)
    with pytest.raises(ValueError):
        add_time_features_hourly(expand_daily_array_to_hourly(raw), calendar="lunar")


def test_text_and_typed_path_agree(spark, session_zone):
    raw = dst_week(spark)
    assert hours_with_time(raw).exceptAll(hourly(raw)).isEmpty()
    assert hours_with_time(raw).count() == hourly(raw).count() == 240


def test_hourly_column_order(spark):
    hours = hourly_table(golden_year(spark))
    assert [(f.name, f.dataType) for f in hours.schema] == [(f.name, f.dataType) for f in HOURLY]


def test_timestamp_texts(spark, session_zone):
    want = {
        "2022-03-27T03:00:00+02:00": datetime.datetime(2022, 3, 27, 1),
        "2022-03-27T03:00:00+0200": datetime.datetime(2022, 3, 27, 1),
        "2022-03-27 03:00:00-05:00": datetime.datetime(2022, 3, 27, 8),
        "2022-03-27T03:00:00Z": datetime.datetime(2022, 3, 27, 3),
        "2022-03-13T02:30:00Z": datetime.datetime(2022, 3, 13, 2, 30),  # a gap in New York
        "2022-01-01T12:00:00": datetime.datetime(2022, 1, 1, 10),
        "2022-07-01 12:00:00": datetime.datetime(2022, 7, 1, 9),
        "2022-01-01": datetime.datetime(2021, 12, 31, 22),
        "2022-03-27T03:30:00": None,  # does not exist in Vilnius
        "2022-10-30T03:30:00": None,  # exists twice
        "2022-10-30T04:00:00": datetime.datetime(2022, 10, 30, 2),
        "01-01-2022": None,
        "junk": None,
    }
    df = spark.createDataFrame([("m", t, 1.0) for t in [*want, None]],
                               "ext_dev_ref string, timestamp_local string, consumption_kwh double")
    got = {r.timestamp_local: r.timestamp for r in add_time_features_hourly(df).collect()}
    assert got == {t: v for t, v in want.items() if v is not None}
    rejects = {r.timestamp_local for r in unparsed_timestamps(df).collect()}
    assert rejects == {None, *(t for t, v in want.items() if v is None)}


def test_typed_timestamps(spark, session_zone):
    df = spark.sql("SELECT TIMESTAMP'2022-03-13T02:30:00Z' AS aware, TIMESTAMP_NTZ'2022-01-01 12:00:00' AS naive")
    assert add_time_features_hourly(df, "aware").first().timestamp == datetime.datetime(2022, 3, 13, 2, 30)
    assert add_time_features_hourly(df, "naive").first().timestamp == datetime.datetime(2022, 1, 1, 10)
    with pytest.raises(KeyError):
        add_time_features_hourly(df, "missing")


def brute_lookback(rows, lags=(1, 24), n=24):
    """Features per row, computed in Python from sorted rows of one meter."""
    out = []
    for i, r in enumerate(rows):
        before = [x.consumption_kwh for x in rows[max(0, i - n):i] if x.consumption_kwh is not None]
        out.append((
            *[rows[i - k].consumption_kwh if i >= k else None for k in lags],
            sum(before) / len(before) if before else None,
            statistics.stdev(before) if len(before) > 1 else 0.0,
        ))
    return out


def assert_lookback(found, order=lambda r: (r.timestamp, r.timestamp_local)):
    by_meter = {}
    for r in found:
        by_meter.setdefault(r.ext_dev_ref, []).append(r)
    for meter, rows in by_meter.items():
        rows.sort(key=order)
        for r, want in zip(rows, brute_lookback(rows)):
            got = (r.lag_1h, r.lag_24h, r.rolling_mean_24h, r.rolling_std_24h)
            for a, b in zip(got, want):
                assert (a is None) == (b is None), (r, want)
                assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (r, want)


def gaps_and_nulls(spark, seed=3):
    """Meters with missing days, null readings and clock changes."""
    rng = random.Random(seed)
    rows = []
    for m in range(4):
        for i in range(40):
            if rng.random() < 0.7:
                day = datetime.date(2022, 3, 10) + datetime.timedelta(days=i)
                rows.append(("c", day, f"m{m}", [rng.choice([None, rng.randrange(100)]) for _ in range(24)]))
    return meter_days(spark, rows)


@pytest.mark.parametrize("limit", [1_000_000, 1, 30])
def test_lookback_whole_and_sliced(spark, limit):
    hours = hourly(gaps_and_nulls(spark))
    found = add_lookback_features(hours, Lookback((1, 24), 24), limit=limit)
    assert found.columns == HOURLY.names
    rows = found.collect()
    assert len(rows) == hours.count()
    assert_lookback(rows)


@pytest.mark.parametrize("limit", [1_000_000, 24])
def test_pipeline_lookback(spark, limit):
    rows = hourly_table(gaps_and_nulls(spark), Options(max_rows_per_slice=limit)).collect()
    assert_lookback(rows)


def copies(spark):
    """A meter id shared by many clients and copies of one of its days, and an ordinary meter."""
    rng = random.Random(5)
    rows = [(f"c{k}", f"2022-01-0{d}", "shared", [rng.randrange(50) for _ in range(24)])
            for k in range(30) for d in (1, 2, 4)]
    rows += [("c0", "2022-01-05", "shared", list(range(24)))] * 80
    rows += [("c", f"2022-01-0{d}", "plain", [d * h for h in range(24)]) for d in range(1, 6)]
    return meter_days(spark, rows)


def test_hot_meter_is_sliced_without_changing_values(spark, tmp_path):
    copies(spark).repartition(5).write.parquet(str(tmp_path / "in"))
    raw = read_all_parquets(spark, str(tmp_path / "in/*.parquet"), source_row=True)
    whole = hourly_table(raw, Options(max_rows_per_slice=10_000_000))
    sliced = hourly_table(raw, Options(max_rows_per_slice=240))
    six = lambda df: df.withColumns({c: F.round(c, 6) for c in ("rolling_mean_24h", "rolling_std_24h")}).drop("source_row")
    assert whole.count() == sliced.count() == 24 * (90 + 80 + 5)
    assert six(whole).exceptAll(six(sliced)).isEmpty()
    # The 81st to 1920th of the equal hours see nothing but equal readings.
    tail = sliced.where("ext_dev_ref = 'shared' AND date_local = '2022-01-05' AND hour = 10")
    assert {(r.lag_1h, r.lag_24h) for r in tail.collect()} >= {(12.0, 12.0)}


def largest_slice(hours, limit):
    """(rows of the largest slice, number of slices)."""
    rows = with_row_id(hours).withColumn(DAY, F.to_date("timestamp"))
    counts = rows.groupBy(METER, DAY).agg(F.count("*").alias("n")).withColumn("_spread", F.lit(0).cast("bigint"))
    sizes = with_slice_key(with_slices(rows, slice_days(counts, limit))).groupBy(*SLICE_KEY).count()
    return tuple(sizes.agg(F.max("count"), F.count("*")).first())


def test_slices_of_a_meter_with_distinct_instants_only(spark):
    days = [(str(datetime.date(2022, 1, 1) + datetime.timedelta(days=i))) for i in range(40)]
    hours = hourly(meter_days(spark, [("c", d, "m", [1] * 24) for d in days]))
    most, slices = largest_slice(hours, 100)
    # A slice has at most the limit and one day; so the carried rows are 24 for about 100, not all of them.
    assert most <= 100 + 24 and slices <= 10


def test_slices_of_equal_copies(spark):
    hours = hourly(meter_days(spark, [("c", "2022-01-05", "m", list(range(24)))] * 1000))
    most, slices = largest_slice(hours, 100)
    # 24 instants of 1000 rows, each cut into 240 parts: no row id is shared by copies.
    assert most <= 100 and slices > 24 * 50


def test_null_meter_has_no_lookback(spark):
    df = meter_days(spark, [("c", f"2022-01-0{d}", None, [d] * 24) for d in (1, 2, 3)])
    for rows in (hourly_table(df).collect(),
                 add_lookback_features(hourly(df), Lookback((1, 24), 24)).collect()):
        assert len(rows) == 72
        assert all((r.lag_1h, r.lag_24h, r.rolling_mean_24h, r.rolling_std_24h) == (None,) * 4 for r in rows)


def test_lags_and_rolling_parameters(spark):
    hours = hourly(two_meters_ramp(spark))
    lags = add_lag_features(hours, lags=[0, 2, 48])
    assert lags.columns[-3:] == ["lag_0h", "lag_2h", "lag_48h"]
    row = lags.where("ext_dev_ref = 'm1' AND timestamp_local = '2023-05-04T00:00:00+03:00'").first()
    assert (row.consumption_kwh, row.lag_0h, row.lag_2h, row.lag_48h) == (13.0, 13.0, 34.0, 11.0)
    rolled = add_rolling_features_hourly(hours, window_hours=3)
    row = rolled.where("ext_dev_ref = 'm1' AND timestamp_local = '2023-05-01T03:00:00+03:00'").first()
    assert (row.rolling_mean_3h, row.rolling_std_3h) == (11.0, 1.0)
    first = rolled.where("ext_dev_ref = 'm1' AND timestamp_local = '2023-05-01T00:00:00+03:00'").first()
    assert (first.rolling_mean_3h, first.rolling_std_3h) == (None, 0.0)
    with pytest.raises(ValueError):
        add_lag_features(hours, lags=[-1])
    with pytest.raises(KeyError):
        add_lag_features(hours, ts_col="missing")
    with pytest.raises(KeyError):
        add_rolling_features_hourly(hours, ts_col="missing")


def test_duplicate_instant_is_ordered_by_local_text(spark):
    rows = hourly_table(dst_week(spark)).where("timestamp = TIMESTAMP_NTZ'2022-03-27 21:00:00'")
    got = {r.timestamp_local: (r.consumption_kwh, r.lag_1h) for r in rows.collect()}
    assert got == {
        "2022-03-27T23:00:00+02:00": (223.0, 222.0),
        "2022-03-28T00:00:00+03:00": (300.0, 223.0),
    }


def test_read_no_file(spark, tmp_path):
    df = read_all_parquets(spark, str(tmp_path / "*.parquet"), source_row=True)
    assert df.isEmpty()
    assert df.columns == [*METER_DAYS.names, "source_row"]
    assert hourly_table(df).isEmpty()


def test_read_files_with_different_columns(spark, tmp_path):
    year = golden_year(spark)
    year.where("month(date) = 1").write.parquet(str(tmp_path / "a.parquet"))
    year.where("month(date) = 2").drop("resolution").select(
        "energy_consumption", "ext_dev_ref", "date", "client_id").write.parquet(str(tmp_path / "b.parquet"))
    for schema in (None, METER_DAYS):
        df = read_all_parquets(spark, str(tmp_path / "*.parquet"), schema)
        assert set(df.columns) == set(METER_DAYS.names)
        assert df.groupBy("resolution").count().orderBy("resolution").collect() == [(None, 28), ("PT1H", 31)]


def test_source_rows_are_distinct(spark, tmp_path):
    copies(spark).repartition(3).write.parquet(str(tmp_path / "in"))
    df = read_all_parquets(spark, str(tmp_path / "in/*.parquet"), source_row=True)
    assert df.select("source_row").distinct().count() == df.count() == 175


def test_drop_repeated_meter_days(spark, tmp_path):
    assert drop_repeated_meter_days(copies(spark)).count() == 90 + 1 + 5
    meter_days(spark, [("c", "2022-01-01", "m", [9] * 24), ("c", "2022-01-01", "m", [1] * 24)]).coalesce(1).write.parquet(
        str(tmp_path / "in"))
    placed = read_all_parquets(spark, str(tmp_path / "in/*.parquet"), source_row=True)
    first = placed.orderBy("source_row").first()
    assert drop_repeated_meter_days(placed).collect() == [first]
    assert drop_repeated_meter_days(placed.drop("source_row")).first().energy_consumption == [1] * 24


def test_files_of_different_types(spark, tmp_path):
    year = golden_year(spark)
    year.where("month(date) = 1").write.parquet(str(tmp_path / "a"))
    year.where("month(date) = 2").selectExpr(
        "client_id", "ext_dev_ref", "date_format(date, 'MMM d, yyyy') AS date",
        "CAST(energy_consumption AS array<double>) AS energy_consumption").write.parquet(str(tmp_path / "b"))
    df = read_all_parquets(spark, str(tmp_path / "*/*.parquet"), source_row=True)
    hours = expand_daily_array_to_hourly(df)
    assert hours.count() == 24 * 59 and hours.select("date_local").distinct().count() == 59
    assert df.select("source_row").distinct().count() == 59


def test_declared_schema_still_misses_a_column(spark, tmp_path):
    golden_year(spark).drop("ext_dev_ref").write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="ext_dev_ref"):
        read_all_parquets(spark, str(tmp_path / "in/*.parquet"), METER_DAYS)


@pytest.mark.parametrize("text, utc", [
    ("2022-01-05T10:00:00+05", "05:00"), ("2022-01-05 10:00:00 UTC", "10:00"), ("2022-01-05T10:00:00GMT", "10:00"),
    ("2022-01-05 10:00:00 America/New_York", "15:00"), ("2022-01-05T10:00:00-5:00", "15:00"),
    ("2022-01-05T10:00+05:30", "04:30"), ("2022-01-05T10+02:00", "08:00"), ("2022-01-05t10:00:00z", "10:00"),
    ("20220105T100000", "08:00"), ("20220105T100000Z", "10:00"), ("20220105T1000+0100", "09:00"),
    ("2022-01-05 10:00:00.25", "08:00"), ("2022-01-05T10:00:00,5+02:00", "08:00"), ("2022-1-5 1:30", None),
    ("2022-01-05", None), ("2022-01-05T10:00:00+25:00", "reject"), ("2022-01-05T10:00:00+02:75", "reject"),
    ("2022-01-05T10:00:00 Nowhere/City", "reject"), ("2022-13-05T10:00:00", "reject"), ("01-01-2022", "reject"),
    ("2022-01-05T25:00:00", "reject"), ("2022-01-05T10:00:00 XYZ 5", "reject"), ("", "reject"), ("T10:00", "reject")])
def test_notations(spark, session_zone, text, utc):
    df = spark.createDataFrame([(text,)], "t string")
    got = add_time_features_hourly(df, "t").collect()
    if utc == "reject":
        assert got == [] and unparsed_timestamps(df, "t").count() == 1
    elif utc:
        assert got[0].timestamp.strftime("%H:%M") == utc and str(got[0].date_local) == "2022-01-05"
    else:  # local times of Vilnius, two hours ahead
        assert str(got[0].timestamp) in ("2022-01-04 23:30:00", "2022-01-04 22:00:00")


@pytest.mark.parametrize("text, utc", [
    ("2022-04-03T01:45:00", None), ("2022-04-03T01:15:00", "2022-04-02 14:15:00") , ("2022-04-03T02:15:00", "2022-04-02 15:45:00"),
    ("2022-10-02T02:15:00", None), ("2022-10-02T02:45:00", "2022-10-01 15:45:00")])
def test_half_hour_clock_change(spark, text, utc):
    df = spark.createDataFrame([(text,)], "t string")
    got = [str(r.timestamp) for r in add_time_features_hourly(df, "t", timezone="Australia/Lord_Howe").collect()]
    assert got == ([utc] if utc else [])
