"""What the physical plans must look like, on stored input."""

import re

import pytest
from fixtures import two_meters_ramp

from bindings.queries import _kept, _numbered
from gridtally.operators.daily import aggregate_daily_measures
from gridtally.operators.similarity import daily_load_similarity
from gridtally.plans.pipeline import BuiltTables, daily_table, hourly_table, hours_with_time
from gridtally.plans.reports import REPORTS
from gridtally.sources.meter_days import read_all_parquets


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("plans") / "in"
    two_meters_ramp(spark).write.parquet(str(path))
    return read_all_parquets(spark, str(path / "*.parquet"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The adaptive plan after a run."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def keys(exchange: str) -> list[str]:
    return [re.sub(r"#\d+L?$", "", part.strip()) for part in exchange.split(",")[:-1]]


def test_no_python_and_no_cartesian(raw):
    frames = [hourly_table(raw), daily_table(raw), daily_load_similarity(hours_with_time(raw)),
              *(report(BuiltTables(raw)) for report in REPORTS.values())]
    for df in frames:
        text = plan(df)
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_daily_is_two_exchanges_and_hash_aggregates(raw):
    text = plan(daily_table(raw))
    assert [keys(e) for e in exchanges(text)] == [
        ["client_id", "ext_dev_ref"], ["client_id", "ext_dev_ref", "date_local"]]
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2
    assert "Join" not in text  # holidays come from the date


def test_daily_reads_needed_columns_only(raw):
    schema = re.search(r"ReadSchema: struct<([^>]*>?[^>]*)>", plan(aggregate_daily_measures(hours_with_time(raw))))
    assert "resolution" not in schema.group(1)


def test_hourly_shuffles_meter_days_once(raw):
    """Without a meter of several slices nothing is carried over, and one shuffle of the
    meter-days by slice (arrays, before the expansion) is all that the windows need."""
    text = final_plan(hourly_table(raw))
    assert "Union" not in text
    assert [keys(e) for e in exchanges(text) if "_slice" in keys(e)] == [["ext_dev_ref", "_spread", "_slice"]]
    assert text.index("Window") < text.index("Generate explode") < text.index("_slice", text.index("Exchange hashpartitioning"))


def test_carried_rows_join_the_slices_without_a_shuffle_of_the_hours(raw):
    text = plan(hourly_table(raw))
    first = text.index("Union")
    assert "Exchange" not in text[:first]


def test_day_counts_read_two_columns_and_no_row_places(spark, raw):
    placed = read_all_parquets(spark, raw.inputFiles()[0], raw.schema, source_row=True)
    counting = [line for line in plan(hourly_table(placed, meters=raw)).splitlines()
                if "ReadSchema: struct<date:date,ext_dev_ref:string>" in line]
    assert counting and not any("row_index" in line for line in counting)


def test_top_k_reports(raw):
    for name in ("top_meters_by_year", "similar_meters"):
        assert "TakeOrderedAndProject" in plan(REPORTS[name](BuiltTables(raw)))


def test_hourly_profile_needs_no_window(raw):
    """The lags are pruned away; the branch for oversized meters goes when there are none."""
    text = final_plan(REPORTS["hourly_profile_avg"](BuiltTables(raw)))
    assert "Window" not in text and "Union" not in text


def test_rows_of_files_are_numbered_file_by_file(spark):
    files = {"b": 3, "a": 5, "c": 1}
    rows = [(name, 100 * i + 7) for name, n in files.items() for i in range(n)]
    numbered = _numbered(spark.createDataFrame(rows, "file string, line bigint"))
    assert [r["place"] for r in numbered.orderBy("file", "line").collect()] == list(range(1, 10))
    text = plan(numbered)
    for single in text.split("Exchange SinglePartition")[1:]:  # only the counts of files come together
        assert "HashAggregate" in single.split("Scan")[0]
    assert "row_number() windowspecdefinition(file#" in text and not re.search(r"row_number\(\) windowspecdefinition\(file#\d+ ASC", text)


def test_results_outlive_their_tables_without_the_driver(spark, tmp_path, monkeypatch):
    root = tmp_path / "root"
    spark.range(7).write.parquet(str(root / "table"))
    result = spark.read.parquet(str(root / "table"))
    with monkeypatch.context() as m:
        m.setattr(type(result), "collect", lambda self: pytest.fail("collected"))
        kept = _kept(spark, result, str(root))
    assert not root.exists() and sorted(r["id"] for r in kept.collect()) == list(range(7))
