import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import SF
from tidemark.functions.weeks import activity_frame, orders_activity
from tidemark.operators.aggregate import weekly_distinct_users
from tidemark.operators.audit import table_history
from tidemark.plans.jobs import Target, load_scenario, parse_partitions, register_target, rollover_days, run_overwrite, target_of
from tidemark.plans.tables import TableDef, table_location


@pytest.fixture()
def landing(spark, scratch):
    path = scratch("landing")
    activity_frame(spark.read.parquet(f"{SF}/events.parquet")).write.parquet(path)
    return path


@pytest.fixture()
def schema(spark):
    name = f"tm_job_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def _weekly(spark, warehouse, schema):
    df = spark.read.parquet(table_location(warehouse, schema, "daily_activity"))
    return {r.year_woy: r.distinct_daily_users for r in df.collect()}


def _expected(spark, landing, cond):
    df = spark.read.parquet(landing).where(cond)
    return {r.year_woy: r.distinct_daily_users for r in weekly_distinct_users(df).collect()}


def test_latest_on_fresh_target_raises(spark, scratch, landing, schema):
    with pytest.raises(ValueError, match="Cannot find the latest partition."):
        run_overwrite(spark, landing=landing, warehouse=scratch("wh"), schema=schema, scenario=0)


def test_backfill_then_cherry_pick_then_latest(spark, scratch, landing, schema):
    wh, audit = scratch("wh"), scratch("audit")
    job = {"landing": landing, "warehouse": wh, "schema": schema, "audit": audit}
    m = run_overwrite(spark, scenario=0, backfill=True, **job)
    assert m["mode"] == "trivial" and m["partitions_before"] == 0 and m["partitions_after"] == 5
    assert _weekly(spark, wh, schema) == _expected(spark, landing, F.col("scenario") == 0)

    req = json.dumps({"year_woy": ["2024_02"]})
    m = run_overwrite(spark, scenario=1, partitions=req, **job)
    assert m["mode"] == "cherry_pick" and m["rows"] == 1
    exp = _expected(spark, landing, F.col("scenario") == 0)
    exp["2024_02"] = _expected(spark, landing, F.col("scenario") == 1)["2024_02"]
    assert _weekly(spark, wh, schema) == exp

    m = run_overwrite(spark, scenario=1, **job)
    assert m["mode"] == "latest" and m["rows"] == 0  # nothing newer than the newest week
    assert _weekly(spark, wh, schema) == exp
    history = table_history(spark, audit, "daily_activity").collect()
    assert [r.operation for r in history] == ["REPLACE:latest", "REPLACE:cherry_pick", "REPLACE:trivial"]
    assert [r.partitions_after for r in history] == [5, 5, 5]


def test_second_warehouse_under_the_same_schema_raises(spark, scratch, landing, schema):
    run_overwrite(spark, landing=landing, warehouse=scratch("one"), schema=schema, scenario=0, backfill=True)
    with pytest.raises(ValueError, match="exists, but it is at"):
        run_overwrite(spark, landing=landing, warehouse=scratch("two"), schema=schema, scenario=0, backfill=True)


def test_request_with_another_key_is_refused_up_front(spark, scratch, landing, schema):
    req = [{"year_woy": "2024_01", "activity_type": "click"}]
    with pytest.raises(ValueError, match="no partition keys"):
        run_overwrite(spark, landing=landing, warehouse=scratch("wh"), schema=schema, scenario=0, partitions=req)


def test_registered_target_and_unknown_one(spark, scratch, landing, schema):
    definition = TableDef(StructType([StructField("year_woy", StringType()), StructField("users", LongType())]), ("year_woy",))

    def build(activity, predicate):
        rows = activity.select(F.col("__year_week_of_year__").alias("year_woy"), "user_id").where(predicate)
        return rows.groupBy("year_woy").agg(F.count("user_id").alias("users"))

    register_target("idempotent", "weekly_rows", Target(definition, build))
    wh = scratch("wh")
    run_overwrite(spark, landing=landing, warehouse=wh, schema=schema, scenario=2, backfill=True, table="weekly_rows", fmt="orc")
    want = spark.read.parquet(landing).where("scenario = 2").groupBy("__year_week_of_year__").count().collect()
    assert sorted(spark.table(f"{schema}.weekly_rows").select("year_woy", "users").collect()) == sorted(tuple(r) for r in want)
    with pytest.raises(ValueError, match="not a target"):
        target_of("idempotent", "nope")


def test_load_gives_about_one_file_a_week_for_landing_in_any_order(spark, scratch):
    landing, target = scratch("random"), scratch("ua")
    activity = orders_activity(spark.read.parquet(f"{SF}/orders.parquet"))
    activity.withColumn("scenario", F.lit(0)).orderBy(F.xxhash64("user_id", "activity_date")).repartition(16).write.parquet(landing)
    load_scenario(spark, landing, target, 0)
    weeks = activity.select("__year_week_of_year__").distinct().count()
    files = spark.read.parquet(target).select(F.input_file_name()).distinct().count()
    assert weeks <= files <= weeks * 1.1


def test_parse_partitions():
    assert parse_partitions(None) is None and parse_partitions("  ") is None
    assert parse_partitions('{"year_woy": ["2024_01"]}') == {"year_woy": ["2024_01"]}
    with pytest.raises(ValueError):
        parse_partitions("3")


def test_rollover_days(spark):
    df = spark.createDataFrame(
        [("2024-01-01",), ("2024-01-02",), ("2024-01-08",), ("2021-01-01",), ("2021-01-02",)], "d STRING"
    ).select(F.to_date("d").alias("activity_date"))
    got = sorted(str(r[0]) for r in rollover_days(df).collect())
    assert got == ["2021-01-01", "2024-01-01", "2024-01-08"]


def test_replace_load_mode_keeps_other_weeks(spark, scratch, landing):
    target = scratch("ua")
    load_scenario(spark, landing, target, 0)
    early = scratch("early")
    spark.read.parquet(landing).where("__year_week_of_year__ = '2024_01'").write.parquet(early)
    load_scenario(spark, early, target, 1, mode="replace", files_per_partition=2)
    got = spark.read.parquet(target)
    assert got.where("__year_week_of_year__ = '2024_01'").select("scenario").distinct().collect()[0][0] == 1
    assert {r[0] for r in got.where("__year_week_of_year__ <> '2024_01'").select("scenario").distinct().collect()} == {0}
    with pytest.raises(ValueError, match="load mode"):
        load_scenario(spark, landing, target, 0, mode="merge")


def test_catalog_tables_follow_the_job(spark, scratch, landing, schema):
    wh = scratch("whcat")
    run_overwrite(spark, landing=landing, warehouse=wh, schema=schema, scenario=0, backfill=True)
    got = {r.year_woy: r.distinct_daily_users for r in spark.table(f"{schema}.daily_activity").collect()}
    assert got == _weekly(spark, wh, schema)
    assert spark.table(f"{schema}.user_activity").count() == spark.read.parquet(landing).where("scenario = 0").count()
    # A full overwrite with fewer weeks: the catalog loses the others.
    early = scratch("early")
    spark.read.parquet(landing).where("__year_week_of_year__ <= '2024_02'").write.parquet(early)
    run_overwrite(spark, landing=early, warehouse=wh, schema=schema, scenario=1, backfill=True)
    listed = [r.partition for r in spark.sql(f"SHOW PARTITIONS {schema}.user_activity").collect()]
    assert listed == ["__year_week_of_year__=2024_01", "__year_week_of_year__=2024_02"]
    assert "scenario" in spark.table(f"{schema}.user_activity").columns
    assert spark.sql(f"SHOW PARTITIONS {schema}.daily_activity").count() == 5


def test_layouts_of_the_load_give_the_same_weekly_table(spark, scratch, landing, schema):
    want = _expected(spark, landing, F.col("scenario") == 2)
    for i, kw in enumerate(({}, {"rebalance": False}, {"load_mode": "replace"}, {"files_per_partition": 2})):
        wh = scratch("wh")
        m = run_overwrite(spark, landing=landing, warehouse=wh, schema=f"{schema}_{i}", scenario=2, backfill=True, **kw)
        assert _weekly(spark, wh, f"{schema}_{i}") == want
        assert m["partitions_after"] == m["rows"] == len(want)
        spark.sql(f"DROP SCHEMA {schema}_{i} CASCADE")
