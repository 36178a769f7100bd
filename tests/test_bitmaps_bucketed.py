from pyspark.sql import functions as F

from conftest import SF
from helpers import files_scanned, plan_text
from tidemark.functions.weeks import STORED_WEEK, WEEK, activity_frame
from tidemark.operators import bitmaps
from tidemark.operators.aggregate import weekly_distinct_users
from tidemark.operators.bitmaps import add_to_bitmaps, bitmap_counts, merge_bitmaps, read_bitmaps, week_bitmaps
from tidemark.plans.bucketed import write_bucketed


def _weekly(df):
    return {r.year_woy: r.distinct_daily_users for r in df.collect()}


def _rows(spark, rows):
    return spark.createDataFrame(rows, f"user_id long, {STORED_WEEK} string")


USERS = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**40, -(2**40), 2**63 - 1, -(2**63), None]


def test_counts_equal_distinct_users(spark):
    rows = _rows(spark, [(u, w) for w in ("a", "b", None, "") for u in USERS for _ in range(2)] + [(None, "only null"), (5, "b")])
    want = _weekly(weekly_distinct_users(rows.withColumn(STORED_WEEK, F.nullif(STORED_WEEK, F.lit("")))))
    assert _weekly(bitmap_counts(week_bitmaps(rows))) == want
    parts = [week_bitmaps(rows.where(F.col("user_id") % 2 == 0)), week_bitmaps(rows.where("user_id % 2 <> 0 OR user_id IS NULL"))]
    assert _weekly(bitmap_counts(merge_bitmaps(*parts))) == want


def test_adding_rows_merges_without_reading_the_week_again(spark, scratch, monkeypatch):
    store = scratch()
    activity = activity_frame(spark.read.parquet(f"{SF}/events.parquet"))
    first, second = activity.where("scenario < 2"), activity.where("scenario = 2")
    assert add_to_bitmaps(spark, first, store) == {"weeks": [f"2024_0{i}" for i in range(1, 6)]}
    read = []
    monkeypatch.setattr(bitmaps, "read_bitmaps", lambda s, path, weeks: read.append(weeks) or read_bitmaps(s, path, weeks))
    week = second.where(F.col(STORED_WEEK) == "2024_02")
    add_to_bitmaps(spark, week, store)
    assert read == [["2024_02"]]
    rest = second.where(F.col(STORED_WEEK) != "2024_02")
    for _ in range(2):  # adding the same rows again changes nothing
        add_to_bitmaps(spark, rest, store)
        stored = spark.read.parquet(store)
        assert _weekly(bitmap_counts(stored)) == _weekly(weekly_distinct_users(activity))
    assert add_to_bitmaps(spark, activity.limit(0), store) == {"weeks": []}


def test_null_weeks_and_users_in_the_store(spark, scratch):
    store = scratch()
    add_to_bitmaps(spark, _rows(spark, [(1, None), (None, "x"), (2, "")]), store)
    assert add_to_bitmaps(spark, _rows(spark, [(3, None), (1, None), (7, "x")]), store) == {"weeks": ["x", None]}
    assert _weekly(bitmap_counts(read_bitmaps(spark, store, ["x", None, "nothing"]))) == {"x": 1, None: 3}


def test_bucketed_table_needs_one_small_exchange(spark, scratch):
    activity = activity_frame(spark.read.parquet(f"{SF}/events.parquet")).unionByName(
        spark.createDataFrame([(None, None, "x", "2024_01", 0), (-3, None, "x", None, 0)], "user_id long, activity_date date, activity_type string, __year_week_of_year__ string, scenario int")
    )
    name = "tm_bucketed_activity"
    write_bucketed(activity, name, scratch(), 4)
    weekly = weekly_distinct_users(spark.table(name))
    exchanges = [line for line in plan_text(weekly, "simple").splitlines() if "Exchange hashpartitioning" in line]
    assert _weekly(weekly) == _weekly(weekly_distinct_users(activity))
    assert len(exchanges) == 1 and "user_id" not in exchanges[0] and WEEK in exchanges[0]
    # A week still prunes its folder, and its buckets are the only files.
    one = weekly_distinct_users(spark.table(name), F.col(WEEK) == "2024_02")
    assert len(one.collect()) == 1 and 0 < files_scanned(one) <= 4
    spark.sql(f"DROP TABLE {name}")
