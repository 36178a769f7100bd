"""Plan assertions: pruning, column pruning, aggregate shape, no nested-loop joins."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from helpers import files_scanned, plan_text
from tidemark.functions.predicates import cherry_pick, latest
from tidemark.functions.weeks import STORED_WEEK, WEEK, orders_activity
from tidemark.operators.aggregate import latest_partition, weekly_distinct_users
from tidemark.operators.select import keep_requested, requests_frame
from tidemark.operators.sinks import overwrite_all, scan_roots


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from tidemark.paths import fresh_dir

    path = fresh_dir(spark, "plans")
    overwrite_all(orders_activity(spark.read.parquet(f"{SF}/orders.parquet")), path, [STORED_WEEK])
    return spark.read.parquet(path)


def test_cherry_pick_prunes_partitions_and_columns(stored):
    plan = plan_text(weekly_distinct_users(stored, cherry_pick({WEEK: ["1997_05", "1997_06"]})))
    pf = [ln for ln in plan.splitlines() if ln.startswith("PartitionFilters:")]
    assert pf and STORED_WEEK in pf[0] and "1997_05" in pf[0] and "1997_06" in pf[0]
    assert "ReadSchema: struct<user_id:bigint>" in plan
    # Distinct aggregate: the big shuffle is keyed by (week, user), then by week.
    assert "hashpartitioning(year_woy#" in plan and ", user_id#" in plan


def test_large_request_is_a_hash_set(stored):
    weeks = [f"1997_{w:02d}" for w in range(1, 54)]
    plan = plan_text(weekly_distinct_users(stored, cherry_pick({WEEK: weeks})))
    assert "INSET" in plan


@pytest.mark.parametrize("tuples", [1, 11, 53, 156])
def test_tuple_request_reads_only_its_weeks(stored, tuples):
    rows = stored.withColumnRenamed(STORED_WEEK, WEEK)
    present = rows.groupBy(WEEK).agg(F.min("activity_type").alias("activity_type")).orderBy(WEEK).limit(tuples)
    request = [r.asDict() for r in present.collect()]
    weeks = [r[WEEK] for r in request]
    for picked in (rows.where(cherry_pick(request)), keep_requested(rows, requests_frame(rows.sparkSession, request), [WEEK, "activity_type"])):
        counted = picked.groupBy(WEEK).count()  # an exchange: the scan is planned, and its files counted, while it runs
        counted.collect()
        files = stored.where(F.col(STORED_WEEK).isin(weeks)).select(F.input_file_name()).distinct().count()
        assert files_scanned(counted, scan_roots(stored)[0]) == files


def test_request_as_data_reads_only_its_weeks(stored):
    """Two weeks far apart, requested as a DataFrame: dynamic pruning reads their files, and none of the years between."""
    rows = stored.withColumnRenamed(STORED_WEEK, WEEK)
    request = requests_frame(rows.sparkSession, {WEEK: ["1995_01", "2001_20"]})
    counted = keep_requested(rows, request, [WEEK]).groupBy(WEEK).count()
    assert {r[WEEK] for r in counted.collect()} == {"1995_01", "2001_20"}
    files = stored.where(F.col(STORED_WEEK).isin("1995_01", "2001_20")).select(F.input_file_name()).distinct().count()
    assert files_scanned(counted, scan_roots(stored)[0]) == files == 2
    assert "dynamicpruning" in plan_text(counted)


def test_latest_reads_no_data_columns(spark, stored):
    df = stored.select(F.col(STORED_WEEK).alias(WEEK))
    plan = plan_text(latest_partition(df, [WEEK]))
    assert "TakeOrderedAndProject" in plan and "ReadSchema: struct<>" in plan
    pred = latest(df, [WEEK])
    assert df.where(pred).count() == 0  # nothing is newer than the newest week


def test_keep_requested_uses_equi_semi_joins(stored):
    rows = stored.select(F.col(STORED_WEEK).alias(WEEK), "activity_type")
    req = rows.where(F.substring(WEEK, 1, 4) == "1998").select(WEEK, "activity_type").distinct()
    plan = plan_text(keep_requested(rows, req, [WEEK, "activity_type"]))
    assert "LeftSemi" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_python_udf_in_core_plans(stored):
    plan = plan_text(weekly_distinct_users(stored, cherry_pick({WEEK: ["1997_05"]})))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
