from conftest import SF
from tidemark.functions.weeks import activity_frame
from tidemark.operators.aggregate import weekly_distinct_users
from pyspark.sql import functions as F

from tidemark.streaming import replace
from tidemark.streaming.replace import compact_weeks, replace_batch, run_id, start_replace_stream, week_folders


def _weekly(df):
    return {r.year_woy: r.distinct_daily_users for r in df.collect()}


def test_stream_equals_backfill_and_replay_is_idempotent(spark, scratch):
    activity = activity_frame(spark.read.parquet(f"{SF}/events.parquet"))
    landing, store, target = scratch("sl"), scratch("ss"), scratch("st")
    activity.repartitionByRange(3, "activity_date").write.parquet(landing)
    checkpoint = scratch("ck")
    q = start_replace_stream(
        spark, landing=landing, schema=activity.schema, store=store, target=target,
        checkpoint=checkpoint, files_per_batch=1,
    )
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    expected = _weekly(weekly_distinct_users(activity))
    assert _weekly(spark.read.parquet(target)) == expected
    # Replaying a batch of the run rewrites the same directories: no change.
    run = run_id(spark, checkpoint)
    stored = _stored(spark, store)
    files = sorted(f.removeprefix("file://") for f in spark.read.parquet(landing).inputFiles())
    batch = spark.read.schema(activity.schema).parquet(*files[:1])
    for _ in range(2):
        replace_batch(spark, batch, 0, run=run, store=store, target=target)
    assert _weekly(spark.read.parquet(target)) == expected and _stored(spark, store) == stored
    # Another run may use the same batch ids.
    replace_batch(spark, batch, 0, run="other", store=store, target=target)
    assert _weekly(spark.read.parquet(target)) == expected and _stored(spark, store) == stored


def _stored(spark, store):
    rows = spark.read.parquet(store).select("year_woy", "user_id").collect()
    assert len(rows) == len(set(rows))  # every pair once
    return set(rows)


def test_batches_with_null_weeks_and_users(spark, scratch):
    store, target = scratch("ss"), scratch("st")
    schema = "user_id LONG, activity_date DATE, activity_type STRING, __year_week_of_year__ STRING"
    batches = [[(1, None, "a", "w1"), (None, None, "a", "w1"), (2, None, "a", None)], [(1, None, "b", "w1"), (3, None, "b", None)], [(None, None, "c", "w2")], []]
    for i, rows in enumerate(batches):
        n = replace_batch(spark, spark.createDataFrame(rows, schema), i, run="r", store=store, target=target)
        assert n == len({r[3] for r in rows})
    assert _weekly(spark.read.parquet(target)) == {"w1": 1, None: 2, "w2": 0}


def test_store_grows_with_new_pairs_only(spark, scratch):
    """Eight batches of the same rows: the store keeps one copy, and later batches add no file."""
    store, target = scratch("ss"), scratch("st")
    activity = activity_frame(spark.read.parquet(f"{SF}/events.parquet"))
    counts = []
    for i in range(8):
        replace_batch(spark, activity, i, run="r", store=store, target=target)
        counts.append(len(spark.read.parquet(store).inputFiles()))
    assert len(set(counts)) == 1


def test_orc_store_and_target(spark, scratch):
    store, target = scratch("ss"), scratch("st")
    activity = activity_frame(spark.read.parquet(f"{SF}/events.parquet"))
    for i in range(2):
        replace_batch(spark, activity, i, run="r", store=store, target=target, fmt="orc")
    assert _weekly(spark.read.orc(target)) == _weekly(weekly_distinct_users(activity))


def _half(activity, part):
    """Two thirds of the rows; any two parts overlap."""
    return activity.where(F.pmod(F.xxhash64("user_id", "activity_date", "activity_type"), F.lit(3)) != part)


def test_two_live_streams_whose_writes_cross(spark, scratch, monkeypatch):
    """The second run writes its pairs between the first's comparison and its write, and again around its count."""
    store, target = scratch("ss"), scratch("st")
    activity = activity_frame(spark.read.parquet(f"{SF}/events.parquet"))
    late = spark.createDataFrame([("2024_01", -1)], "year_woy string, user_id long")
    expected = _weekly(weekly_distinct_users(activity))
    expected["2024_01"] += 1
    write, calls = replace.replace_partitions, []

    def crossing(df, path, *args, **kwargs):
        calls.append(path)
        if len(calls) == 1:  # the first run has compared, not written yet
            replace_batch(spark, _half(activity, 1), 0, run="b", store=store, target=target)
        written = write(df, path, *args, **kwargs)
        if path == target and calls.count(target) == 2:  # the first run has counted; now new pairs come in
            replace.write_pairs(replace.new_pairs(spark, late, WEEKS, 1, run="b", store=store), store)
        return written

    monkeypatch.setattr(replace, "replace_partitions", crossing)
    assert replace_batch(spark, _half(activity, 0), 0, run="a", store=store, target=target) == 5
    rows = spark.read.parquet(store).select("year_woy", "user_id").collect()
    assert len(rows) > len(set(rows))  # pairs did come twice
    assert _weekly(spark.read.parquet(target)) == expected
    assert calls.count(target) == 3  # counted again, as the store had changed
    # Replays of either batch, and compaction, change nothing.
    monkeypatch.undo()
    for run, part in (("a", 0), ("b", 1)):
        replace_batch(spark, _half(activity, part), 0, run=run, store=store, target=target)
    compact_weeks(spark, store, WEEKS)
    replace_batch(spark, _half(activity, 0), 0, run="a", store=store, target=target)
    assert _weekly(spark.read.parquet(target)) == expected
    assert len(_stored(spark, store)) == len(set(rows))  # every pair once again


WEEKS = [f"2024_0{i}" for i in range(1, 6)]


def test_folders_of_a_week_do_not_grow_with_batches(spark, scratch):
    store, target = scratch("ss"), scratch("st")
    schema = "user_id LONG, activity_date DATE, activity_type STRING, __year_week_of_year__ STRING"
    listed = []
    for i in range(12):  # every batch brings a new user to one week, and to a week of its own
        rows = [(i, None, "a", "w"), (i, None, "a", f"x{i}"), (i, None, "a", None)]
        replace_batch(spark, spark.createDataFrame(rows, schema), i, run="r", store=store, target=target, compact_after=3)
        listed.append(sum(map(len, week_folders(spark, store, ["w", None]).values())))
    assert max(listed) <= 6 and sum(map(len, week_folders(spark, store, ["w"]).values())) <= 3
    assert _weekly(spark.read.parquet(target)) == {"w": 12, None: 12} | {f"x{i}": 1 for i in range(12)}


def test_only_touched_weeks_are_listed(spark, scratch, monkeypatch):
    store, target = scratch("ss"), scratch("st")
    schema = "user_id LONG, activity_date DATE, activity_type STRING, __year_week_of_year__ STRING"
    replace_batch(spark, spark.createDataFrame([(1, None, "a", f"w{i}") for i in range(30)], schema), 0, run="r", store=store, target=target)
    seen = []
    listing = replace.subfolders
    monkeypatch.setattr(replace, "subfolders", lambda s, path: seen.append(path) or listing(s, path))
    replace_batch(spark, spark.createDataFrame([(2, None, "a", "w7"), (1, None, "a", "a b/c=%")], schema), 1, run="r", store=store, target=target)
    assert seen and all("/year_woy=w7" in p or "/year_woy=a b%2Fc%3D%25" in p for p in seen)
    assert _weekly(spark.read.parquet(target)) == {f"w{i}": 1 + (i == 7) for i in range(30)} | {"a b/c=%": 1}


def test_a_folder_compacted_while_it_is_read_is_listed_anew(spark, scratch, monkeypatch):
    store, target = scratch("ss"), scratch("st")
    schema = "user_id LONG, activity_date DATE, activity_type STRING, __year_week_of_year__ STRING"
    for i in range(3):
        replace_batch(spark, spark.createDataFrame([(i, None, "a", "w")], schema), i, run="r", store=store, target=target)
    listing, calls = replace.week_folders, []

    def late(spark, store, weeks):
        found = listing(spark, store, weeks)
        calls.append(weeks)
        if len(calls) == 1:  # compacted between the listing and the read
            monkeypatch.setattr(replace, "week_folders", listing)
            compact_weeks(spark, store, weeks)
            monkeypatch.setattr(replace, "week_folders", late)
        return found

    monkeypatch.setattr(replace, "week_folders", late)
    replace_batch(spark, spark.createDataFrame([(7, None, "a", "w")], schema), 3, run="r", store=store, target=target)
    assert _weekly(spark.read.parquet(target)) == {"w": 4}
