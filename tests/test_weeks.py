import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.weeks import STORED_WEEK, activity_frame, iso_week_key


def test_year_ends(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 12, 30),), (dt.date(2021, 1, 1),), (dt.date(2024, 1, 1),), (dt.date(2020, 12, 31),)], "d DATE"
    )
    got = [r[0] for r in df.select(iso_week_key("d")).collect()]
    assert got == ["2025_01", "2020_53", "2024_01", "2020_53"]


def test_matches_python_isocalendar_every_day(spark):
    start, days = dt.date(1995, 1, 1), 36 * 366
    df = spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = {r.d: r.k for r in df.select("d", iso_week_key("d").alias("k")).collect()}
    for d, k in got.items():
        y, w, _ = d.isocalendar()
        assert k == f"{y:04d}_{w:02d}", d


def test_key_sorts_in_time_order(spark):
    df = spark.range(0, 3000, 7).select(F.date_add(F.lit(dt.date(2019, 1, 1)), F.col("id").cast("int")).alias("d"))
    rows = df.select("d", iso_week_key("d").alias("k")).orderBy("d").collect()
    keys = [r.k for r in rows]
    assert keys == sorted(keys)


def test_activity_frame_columns(spark):
    ev = spark.createDataFrame(
        [(5, dt.datetime(2021, 1, 1, 23, 0), 9, "click")], "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING"
    )
    row = activity_frame(ev).first()
    assert row.asDict() == {
        "user_id": 9,
        "activity_date": dt.date(2021, 1, 1),
        "activity_type": "click",
        STORED_WEEK: "2020_53",
        "scenario": 2,
    }
