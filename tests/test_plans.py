"""What the registered plans must and must not contain."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickhouse.operators import costs, decode, readviews
from tickhouse.queries import catalogue, inputs

SF = "/root/testdata/sf0.001"
FORBIDDEN = re.compile(r"PythonUDF|EvalPython|InPandas|InArrow|CartesianProduct|NestedLoop|PythonRDD")


# The exact bars-or-age rule follows a chain of batch starts, which no built-in operator does.
WITH_PYTHON = {"batching_t1_cuts"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(entry.queries()) and entry.FLAGSHIP in entry.queries()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_no_python_no_cross_join_no_global_window(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert name in WITH_PYTHON or not FORBIDDEN.search(plan)
    for line in plan.splitlines():
        if "SinglePartition" in line:
            # Only one-row aggregates may end in a single task; never a window or a sort.
            below = plan[plan.index(line):].split("\n", 2)[1]
            assert "Aggregate" in below or "Union" in below, below


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_bounded_query_prunes_and_pushes(spark, tmp_path):
    bars = decode.stored_bars(inputs.bars(spark, SF), F.col("received_at"))
    bars.write.parquet(str(tmp_path / "bars"))
    start = datetime(2024, 1, 5, tzinfo=timezone.utc)
    stored = spark.read.parquet(str(tmp_path / "bars"))
    plan = plan_of(readviews.bounded(stored, start, start + timedelta(days=1), 10))
    assert "GreaterThanOrEqual(event_ts" in plan and "LessThan(event_ts" in plan
    assert "TakeOrderedAndProject" in plan
    assert "src_offset" not in plan.split("ReadSchema")[1]


def test_billing_bounds_reach_the_scan(spark):
    day = F.to_date(F.lit(datetime(2001, 6, 20, tzinfo=timezone.utc)))
    plan = plan_of(costs.daily_costs(costs.lines_in_lookback(inputs.billing(spark, SF), day), day))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_raw_path_has_no_shuffle(spark):
    frames = spark.createDataFrame(
        [("bars", 0, 0, "[]")], "topic string, part_id int, src_offset long, raw string")
    rows = decode.stored_bars(
        decode.explode_bars(decode.accepted(decode.decode(frames))), F.lit(datetime.now(timezone.utc)))
    plan = plan_of(rows)
    assert "Exchange" not in plan and plan.count("from_json") == 1


def test_dedup_aggregates_narrow_rows_and_prunes_days(spark, tmp_path):
    bars = decode.stored_bars(inputs.bars(spark, SF), F.col("received_at"))
    bars = bars.withColumn("event_date", F.to_date("event_ts"))
    bars.write.partitionBy("event_date").parquet(str(tmp_path / "bars"))
    day = readviews.deduplicated(spark.read.parquet(str(tmp_path / "bars"))).filter(
        F.col("event_date") == "2024-01-05")
    plan = plan_of(day)
    partial = next(line for line in plan.splitlines() if "partial_min" in line)
    assert "close" not in partial  # no full row goes through the aggregate
    assert len(re.findall(r"PartitionFilters: \[[^\]]*2024-01-05", plan)) == 2


@pytest.mark.parametrize("name", ["loader_w4_progress", "loader_w7_stalls"])
def test_health_tracking_is_two_scans(spark, name):
    plan = plan_of(catalogue.QUERIES[name](spark, SF))
    # The first scan ended in a checkpoint; what is left is the second: rows and their carries.
    assert plan.count("Scan ExistingRDD") <= 2 and len(re.findall(r"\w*Join", plan)) <= 2
