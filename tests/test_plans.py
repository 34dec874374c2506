"""The plans that the speed rests on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from incident_stream import fixtures
from incident_stream.operators.aggregate import (
    aggregate_monthly,
    aggregate_windowed,
    anomalies,
)
from incident_stream.plans.pipelines import enriched
from incident_stream.settings import RecordSource, shuffle_partitions
from incident_stream.sources.records import read_record_stream
from incident_stream.streaming.queries import await_all, start_query

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def records(spark):
    return enriched(fixtures.event_lines(spark, SF), fixtures.codes(spark, SF))


@pytest.mark.parametrize("result", [aggregate_monthly, aggregate_windowed, anomalies])
def test_each_line_is_parsed_once(records, result):
    plan = plan_of(result(records))
    assert plan.count("from_csv(") == 1
    assert plan.count("as timestamp)") <= 2  # the event time, and the fixture's own column


@pytest.mark.parametrize("result", [aggregate_monthly, aggregate_windowed, anomalies])
def test_records_are_not_shuffled_before_they_are_summed_up(records, result):
    plan = plan_of(result(records))
    below_first_shuffle = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "partial_count" in below_first_shuffle
    assert "BroadcastHashJoin" in below_first_shuffle
    assert "Python" not in plan and "Arrow" not in plan


def test_windows_are_copied_from_days_and_not_from_records(records):
    lines = plan_of(anomalies(records)).splitlines()
    depth = {key: next(i for i, l in enumerate(lines) if key in l) for key in ("Expand", "inline")}
    between = "\n".join(lines[depth["Expand"] : depth["inline"]])
    assert "Exchange hashpartitioning" in between and "partial_count" in between


def test_only_needed_columns_are_read(records):
    plan = plan_of(anomalies(records))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "events" in line)
    assert "[event_id#" in scan and "props" not in scan and "value#" not in scan


def test_time_slices_reach_the_scan(spark):
    start = fixtures._moment(dt.datetime(2024, 1, 5))
    plan = plan_of(fixtures.event_fields(spark, SF).where(F.col("ts") >= start))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan


def test_streaming_plan(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1,2024-01-01 12:00:00,0110,True,False,1.0,,,\n")
    lines = read_record_stream(spark, RecordSource.text(str(tmp_path / "in")))
    found = anomalies(enriched(lines, fixtures.codes(spark, SF)))
    with shuffle_partitions(spark, 2):
        query = start_query(
            found,
            "append",
            lambda df, _: df.collect(),
            str(tmp_path / "q"),
            {"availableNow": True},
        )
    await_all([query])
    query.explain()
    plan = capsys.readouterr().out
    assert plan.count("from_csv(") == 1
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "partial_sum" in before_shuffle and "BroadcastHashJoin" in before_shuffle
    # the windows are copied from the sums per day and task, not from records
    order = [before_shuffle.index(node) for node in ("Expand", "EventTimeWatermark", "MapInArrow", "from_csv(")]
    assert order == sorted(order)
    assert "Exchange" not in before_shuffle[10:].replace("BroadcastExchange", "")
