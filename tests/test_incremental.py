"""Runs over new meter-days, tables that change together, lookup by meter, counts."""

import datetime
import os

import pytest
from fixtures import dates, golden_year, meter_days, two_meters_ramp
from pyspark.sql import functions as F

from gridtally.plans import incremental, jobs
from gridtally.plans.incremental import Counts, LateMeterDays, last_days
from gridtally.plans.jobs import run_etl, run_queries, write_hours_csv
from gridtally.plans.pipeline import BuiltTables, Options, hours_with_time
from gridtally.plans.reports import DAY_REPORTS, REPORTS, day_measures, day_reports
from gridtally.sources import versions
from gridtally.sources.meter_days import SOURCE_ROW
from gridtally.sources.tables import meter_hours, open_tables, read_table, save_table

NAMES = ("meter_hourly", "meter_daily", "meter_monthly")


def add(spark, tmp_path, name, days, options=Options(), **more):
    days.write.parquet(str(tmp_path / "in" / name))
    return run_etl(spark, str(tmp_path / "in" / name / "*.parquet"), None, str(tmp_path / "tables"), options, if_exists="append", **more)


def same_rows(got, want):
    """Equal but for the last digits of what depends on the order of a sum."""
    tidy = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in want.select(*got.columns).dtypes])
    assert got.count() == want.count()
    assert tidy(got).exceptAll(tidy(want)).isEmpty()


@pytest.mark.parametrize("options, cuts", [
    (Options(), ["2022-03-02", "2022-03-27", "2022-04-02"]),
    (Options(timezone="America/Los_Angeles", calendar="local", lags=(1, 50), window_hours=30, rolling_days=(3,)), ["2022-03-27"]),
    (Options(timezone="America/Los_Angeles", max_rows_per_slice=100), ["2022-03-28", "2023-05-15"])])
def test_parts_make_what_one_run_makes(spark, tmp_path, options, cuts):
    """Cuts inside a month, at its end and at a clock change; meters that begin, pause and end; a day of nulls and a copy."""
    year = golden_year(spark).where("date BETWEEN '2022-02-10' AND '2022-04-10'")
    odd = meter_days(spark, [
        ("x", "2022-03-01", "m9", [1] * 24), ("x", "2022-03-01", "m9", [1] * 24), ("x", "2022-03-27", "m9", [None] * 24),
        ("y", "2022-03-28", "m9", [2] * 24), (None, "2022-03-02", "m8", [1] * 24), ("x", "2022-03-03", None, [1] * 24),
        ("x", "2022-03-04", "m9", [1] * 23), ("x", "2022-04-01", "m7", [5] * 24)])
    everything = year.union(two_meters_ramp(spark)).union(odd)
    ends = [*cuts, "9999-01-01"]
    for k, (a, b) in enumerate(zip(["0001-01-01", *ends], ends)):
        tables = add(spark, tmp_path, str(k), everything.where(f"date >= '{a}' AND date < '{b}'"), options)
    once = BuiltTables(everything, options)
    for name in NAMES:
        same_rows(tables[name], once[name])
    manifest = versions.current(spark, str(tmp_path / "tables"))
    assert manifest.number == len(ends)
    daily = manifest.folders["meter_daily"]
    assert len({versions.partition_of(f) for f in daily}) == len(daily)


def test_late_days_are_refused_and_change_nothing(spark, tmp_path):
    year = golden_year(spark)
    add(spark, tmp_path, "a", year.where("month(date) = 5"))
    before = versions.current(spark, str(tmp_path / "tables"))
    with pytest.raises(LateMeterDays):
        add(spark, tmp_path, "b", year.where("date IN ('2022-05-31', '2022-06-01')"))
    with pytest.raises(ValueError, match="other options"):
        add(spark, tmp_path, "c", year.where("month(date) = 6"), Options(lags=(2,)))
    assert versions.current(spark, str(tmp_path / "tables")) == before


def test_what_a_run_reads_of_the_past(spark, tmp_path, monkeypatch):
    """Of the stored days only the folders of touched months are opened."""
    year = golden_year(spark)
    add(spark, tmp_path, "a", year.where("month(date) <= 6"))
    opened, real = [], versions.open_folders
    monkeypatch.setattr(versions, "open_folders", lambda s, root, table, folders: opened.append((table, list(folders))) or real(s, root, table, folders))
    before = versions.current(spark, str(tmp_path / "tables"))
    add(spark, tmp_path, "b", year.where("date = '2022-07-01'"))
    old = {f for folders in before.folders.values() for f in folders}
    read = [f for table, folders in opened[:-4] for f in folders if f in old and table in ("meter_hourly", "meter_daily", "meter_monthly")]
    assert [versions.partition_of(f) for f in read] == ["stored_month=202206"]  # the UTC day before the first local one


def test_last_days_keep_whole_dates(spark):
    rows = [("c", f"2022-01-0{d}", "m", [d] * 24) for d in (1, 2, 3, 3)] + [("e", "2022-01-01", "m", [9] * 24)]
    days = meter_days(spark, rows).selectExpr("*", f"CAST(1 AS BIGINT) AS {SOURCE_ROW}")
    kept = lambda depth: sorted((r.client_id, r.date.day) for r in last_days(days, Options(lags=(depth,), window_hours=None)).collect())
    assert kept(24) == kept(48) == [("c", 3), ("c", 3), ("e", 1)]
    assert kept(49) == [("c", 2), ("c", 3), ("c", 3), ("e", 1)]
    assert kept(500) == [("c", 1), ("c", 2), ("c", 3), ("c", 3), ("e", 1)]


@pytest.mark.parametrize("mode", ["replace", "append"])
def test_a_run_that_dies_leaves_the_earlier_tables(spark, tmp_path, monkeypatch, mode):
    year, root = golden_year(spark), str(tmp_path / "tables")
    add(spark, tmp_path, "a", year.where("month(date) = 5"))
    want = {name: df.collect() for name, df in open_tables(spark, root).items()}
    year.where("month(date) = 6").write.parquet(str(tmp_path / "in/b"))

    def dies(df, table_name, table_root, *args, **more):
        if table_root.endswith("meter_monthly"):
            raise OSError("killed")
        return save_table(df, table_name, table_root, *args, **more)

    with monkeypatch.context() as m:
        m.setattr(incremental, "save_table", dies)
        with pytest.raises(OSError, match="killed"):
            run_etl(spark, str(tmp_path / "in/b/*.parquet"), None, root, if_exists=mode)
    assert len([f for f in os.listdir(os.path.join(root, "meter_hourly")) if f.startswith("run=")]) == 2
    assert {name: df.collect() for name, df in open_tables(spark, root).items()} == want
    run_etl(spark, str(tmp_path / "in/b/*.parquet"), None, root, if_exists=mode)
    assert open_tables(spark, root)["meter_hourly"].count() == 24 * (30 if mode == "replace" else 61)


def test_two_runs_at_once(spark, tmp_path):
    root = str(tmp_path)
    first = versions.publish(spark, root, None, {"t": ["run=a"]}, {"x": [1]})
    assert versions.current(spark, root) == first == versions.Manifest(1, {"t": ["run=a"]}, {"x": [1]})
    with pytest.raises(versions.ConcurrentRun):
        versions.publish(spark, root, None, {"t": ["run=b"]}, {})
    second = versions.publish(spark, root, first, {"t": ["run=b"]}, {})
    assert versions.current(spark, root) == second
    assert sorted(f for f in os.listdir(tmp_path / "_manifests") if not f.startswith(".")) == ["000000000001.json", "000000000002.json"]


def test_folders_that_no_manifest_names_can_go(spark, tmp_path):
    year, root = golden_year(spark), str(tmp_path / "tables")
    add(spark, tmp_path, "a", year.where("month(date) = 5"))
    add(spark, tmp_path, "b", year.where("month(date) = 6"))
    want = {name: df.collect() for name, df in open_tables(spark, root).items()}
    assert versions.drop_unreferenced(spark, root, keep=2) == []
    gone = versions.drop_unreferenced(spark, root)
    assert {g.split("/")[0] for g in gone} == {"meter_daily", "meter_monthly", "meter_last_days", "meter_totals"}
    assert {name: df.collect() for name, df in open_tables(spark, root).items()} == want
    assert versions.drop_unreferenced(spark, root) == []


def test_an_open_table_stays_that_of_its_run(spark, tmp_path):
    year, root = golden_year(spark), str(tmp_path / "tables")
    early = add(spark, tmp_path, "a", year.where("month(date) = 5"))
    add(spark, tmp_path, "b", year.where("month(date) = 6"))
    assert early["meter_hourly"].count() == 24 * 31 and early["meter_daily"].count() == 32


def test_the_ratio_costs_nothing_where_it_is_not_read(spark, tmp_path):
    daily = add(spark, tmp_path, "a", golden_year(spark).where("month(date) = 5"))["meter_daily"]
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in text(daily) and "Join" not in text(REPORTS["consumption_categories"]({"meter_daily": daily}))
    assert daily.where("weekend_vs_weekday IS NULL").isEmpty()


# Lookup

def test_lookup_by_meter_passes_over_row_groups(spark, tmp_path):
    """Four files of meters in random order, too many for a dictionary: neither ranges nor dictionaries tell where one is."""
    rows = spark.range(100_000, numPartitions=4).selectExpr("sha2(CAST(id AS STRING), 256) AS ext_dev_ref", "id AS v")
    meter = rows.where("v = 30000").first()[0]
    read = {}
    for name, lookup in (("with", ["ext_dev_ref"]), ("without", [])):
        path = save_table(rows, "t", str(tmp_path / name), lookup=lookup)
        found = spark.read.parquet(path).where(F.col("ext_dev_ref") == meter)
        plan = found._jdf.queryExecution().executedPlan()
        assert len(plan.executeCollect()) == 1
        read[name] = plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    assert read == {"with": 25_000, "without": 100_000}


def test_hours_of_one_meter(spark, tmp_path):
    tables = add(spark, tmp_path, "a", two_meters_ramp(spark))
    root = str(tmp_path / "tables")
    every = tables["meter_hourly"].where("ext_dev_ref = 'm2'").orderBy("timestamp", "timestamp_local").collect()
    assert meter_hours(spark, root, "m2").collect() == every and len(every) == 960
    since, until = datetime.datetime(2023, 5, 30, 5), datetime.datetime(2023, 6, 2)
    few = meter_hours(spark, root, "m2", since, until)
    assert few.collect() == [r for r in every if since <= r.timestamp < until]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "EqualTo(ext_dev_ref,m2)" in plan
    assert meter_hours(spark, root, "none").isEmpty()


# Counts and reports

def test_counts_come_with_the_hourly_pass(spark, tmp_path, monkeypatch):
    days = meter_days(spark, [("c", "2022-01-01", "m", [1] * 24), ("c", "2022-01-02", "m", [1] * 23), ("c", None, "m", [1] * 24)])
    texts = days.withColumn("date", days.date.cast("string")).na.fill("soon", ["date"])
    seen = []
    monkeypatch.setattr(jobs, "save_run_metrics", lambda s, counts, *rest: seen.append(counts))
    add(spark, tmp_path, "a", texts)
    add(spark, tmp_path, "b", texts.withColumn("date", texts.date.substr(1, 4)).selectExpr(
        "client_id", "IF(date = 'soon', 'late', '2022-01-05') AS date", "ext_dev_ref", "energy_consumption", "resolution"))
    assert seen == [{"read": 3, "rejected": 2, "unparsed": 1}] * 2


def test_counts_of_a_task_that_ran_twice(spark):
    class Twice:
        get = {"read": 4, "rejected": 2, "unparsed": 0}

    counts = Counts(Options())
    counts.observation = Twice()
    days = meter_days(spark, [("c", "2022-01-01", "m", [1] * 24), ("c", "2022-01-02", "m", [1] * 23)])
    assert counts.checked(days, 24) == {"read": 2, "rejected": 1, "unparsed": 0}
    assert counts.checked(days, 48) == Twice.get


def test_six_reports_from_one_scan(spark, tmp_path):
    daily = add(spark, tmp_path, "a", two_meters_ramp(spark))["meter_daily"]
    plan = day_measures(daily)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    made = day_reports({"meter_daily": daily}, DAY_REPORTS)
    assert len(made) == 6
    for name, report in made.items():
        assert report({}).collect() == REPORTS[name]({"meter_daily": daily}).collect()


def test_reports_by_themselves_if_the_pass_fails(spark, tmp_path):
    """Without the column of one report that one fails, and no other."""
    daily = BuiltTables(two_meters_ramp(spark))["meter_daily"].drop("is_holiday")
    chosen = {name: REPORTS[name] for name in DAY_REPORTS}
    status = {r.report: r.status for r in run_queries(spark, {"meter_daily": daily}, str(tmp_path), chosen).collect()}
    assert status == {name: "failed" if name == "holiday_vs_nonholiday" else "ok" for name in DAY_REPORTS}


# Sorted hours

def lines_of(folder):
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    return [line.split(",") for p in parts for line in (folder / p).read_text().splitlines()[1:]]


def test_sorted_hours_shuffle_arrays_once(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(jobs, "write_csv", lambda df, path: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    two_meters_ramp(spark).write.parquet(str(tmp_path / "in"))
    write_hours_csv(spark.read.parquet(str(tmp_path / "in")), "unused")
    assert plans[0].count("Exchange ") == plans[0].count("rangepartitioning") == 1
    assert plans[0].index("Generate explode") < plans[0].index("rangepartitioning")


@pytest.mark.parametrize("limit", [10_000, 20])
def test_hours_in_order_over_all_files(spark, tmp_path, monkeypatch, limit):
    """Copies of one date are dealt out hour by hour where they are more than the limit, and stay in order."""
    monkeypatch.setattr(jobs, "MAX_COPIES_PER_TASK", limit)
    rows = [("c", d, m, [i] * 24) for i, m in enumerate(("m1", None, "m2")) for d in dates("2022-10-28", 5)]
    rows += [("c", "2022-10-30", "m1", [7] * 24)] * 60 + [("c", None, "m1", [7] * 24)] * 30
    write_hours_csv(meter_days(spark, rows), str(tmp_path / "x.csv"))
    got = [(r[1], r[5]) for r in lines_of(tmp_path / "x.csv")]
    assert len(got) == 24 * (15 + 60) and got == sorted(got)


def test_the_second_midnight(spark):
    days = meter_days(spark, [("c", d, "m", list(range(24))) for d in ("2022-11-05", "2022-11-06", "2022-11-07", "2022-03-13")])
    hours = hours_with_time(days, Options(timezone="America/Havana"))
    first = {r.timestamp_local[:10]: (r.timestamp_local[19:], r.timestamp.hour) for r in hours.where("timestamp_local LIKE '%T00:%'").collect()}
    assert first == {"2022-11-05": ("-04:00", 4), "2022-11-06": ("-05:00", 5), "2022-11-07": ("-05:00", 5), "2022-03-13": ("-05:00", 5)}


def test_parsing_is_a_small_plan(spark):
    from gridtally.operators.hourly import add_time_features_hourly, unparsed_timestamps

    texts = spark.createDataFrame([("2022-05-01T10:00:00+03:00",)], "text string")
    for df in (add_time_features_hourly(texts, "text"), unparsed_timestamps(texts, "text")):
        assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 40_000


def test_months_of_many_runs_become_one_folder(spark, tmp_path):
    year, root = golden_year(spark), str(tmp_path / "tables")
    for k, (a, b) in enumerate((("05-01", "05-20"), ("05-21", "05-25"), ("05-26", "06-03"))):
        tables = add(spark, tmp_path, str(k), year.where(f"date BETWEEN '2022-{a}' AND '2022-{b}'"))
    want = sorted(tables["meter_hourly"].collect())
    assert incremental.compact(spark, root, most=3) is None
    incremental.compact(spark, root, most=2)
    parts = [versions.partition_of(f) for f in versions.current(spark, root).folders["meter_hourly"]]
    assert sorted(parts) == ["year=2022/month=4", "year=2022/month=5", "year=2022/month=6"]
    assert sorted(open_tables(spark, root)["meter_hourly"].collect()) == want
    versions.drop_unreferenced(spark, root)
    later = add(spark, tmp_path, "later", year.where("date = '2022-06-04'"))
    same_rows(later["meter_hourly"], BuiltTables(year.where("date BETWEEN '2022-05-01' AND '2022-06-04'"))["meter_hourly"])
