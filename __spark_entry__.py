"""

``entry(spark)`` runs the flagship query (exact distinct users per ISO week)
callable ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives the DuckDB
SQL computing the same rows from the same parquet tables.

Queries that write (sinks, jobs, stream) write only below the session's
``spark.checkpoint.dir`` (a fresh folder per call) and return the table they
wrote, read back from storage. Every query reads ``events`` or ``orders`` in
full; no query runs on made-up input alone.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.predicates import cherry_pick, everything, latest, strategy  # noqa: E402
from tidemark.functions.weeks import STORED_WEEK, WEEK, activity_frame, orders_activity  # noqa: E402
from tidemark.operators.aggregate import latest_partition, weekly_distinct_users  # noqa: E402
from tidemark.operators.audit import table_history  # noqa: E402
from tidemark.operators.bitmaps import add_to_bitmaps, bitmap_counts  # noqa: E402
from tidemark.operators.select import keep_requested, requests_frame, select_partitions  # noqa: E402
from tidemark.operators.sinks import overwrite_all, replace_partitions, write_sink, writers_for  # noqa: E402
from tidemark.paths import fresh_dir  # noqa: E402
from tidemark.plans.bucketed import write_bucketed  # noqa: E402
from tidemark.plans.jobs import (  # noqa: E402
    due_weeks,
    maintain_weekly_views,
    read_preview_append,
    rollover_days,
    run_overwrite,
    weekly_table_and_view,
)
from tidemark.plans.tables import (  # noqa: E402
    ensure_tables,
    partition_columns,
    table_definition,
    table_exists,
    table_location,
    table_partitions,
)
from tidemark.sources import parse_source, stage_source  # noqa: E402
from tidemark.sources.catalog import read_catalog  # noqa: E402
from tidemark.streaming.replace import (  # noqa: E402
    batch_pairs,
    compact_weeks,
    new_pairs,
    recount_weeks,
    replace_batch,
    start_replace_stream,
    write_pairs,
)

ACTIVITY_COLS = ["user_id", "activity_date", "activity_type", STORED_WEEK, "scenario"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_frame(_events(spark, sf_dir))


def _orders_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_activity(spark.read.parquet(f"{sf_dir}/orders.parquet"))


def _landing(spark: SparkSession, sf_dir: str, where=None, source=None, files: int | None = None) -> str:
    """Write landing data derived from ``events`` (or ``source``) to a fresh shared folder.

    ``files`` splits it into that many files in time order, as landing data
    arrives.
    """
    path = fresh_dir(spark, "landing")
    df = (source or _activity)(spark, sf_dir)
    if where is not None:
        df = df.where(where)
    if files:
        df = df.repartitionByRange(files, "activity_date")
    df.write.mode("overwrite").parquet(path)
    return path


def _warehouse(spark: SparkSession) -> tuple[str, str]:
    """A fresh warehouse folder and a catalog schema name of its own."""
    path = fresh_dir(spark, "warehouse")
    return path, f"tm_{os.path.basename(path).replace('-', '_')}"


def _daily(spark: SparkSession, warehouse: str, schema: str, fmt: str = "parquet") -> DataFrame:
    return _weekly(spark.read.format(fmt).load(table_location(warehouse, schema, "daily_activity")))


def _weekly(df: DataFrame) -> DataFrame:
    return df.select(WEEK, "distinct_daily_users")


# --------------------------------------------------------------------------
# Scans and the flagship aggregate


def q_scan_scenario(spark, sf_dir):
    landing = _landing(spark, sf_dir)
    return spark.read.parquet(landing).where("scenario = 0").select(*ACTIVITY_COLS)


def q_weekly_users_backfill(spark, sf_dir):
    return weekly_distinct_users(_activity(spark, sf_dir), everything())


def q_weekly_users_backfill_orders(spark, sf_dir):
    return weekly_distinct_users(_orders_activity(spark, sf_dir), everything())


# --------------------------------------------------------------------------
# latest


def q_weekly_users_latest(spark, sf_dir):
    # The weekly table currently ends at 2024_03; only newer weeks are selected.
    target = fresh_dir(spark, "weekly")
    activity = _activity(spark, sf_dir)
    replace_partitions(weekly_distinct_users(activity, F.col(WEEK) <= "2024_03"), target, [WEEK])
    predicate = latest(spark.read.parquet(target), [WEEK])
    return weekly_distinct_users(activity, predicate)


def q_weekly_users_latest_orders(spark, sf_dir):
    # The weekly table ends in the last ISO week of 1999; the next key is 2000_01.
    target = fresh_dir(spark, "weekly")
    activity = _orders_activity(spark, sf_dir)
    weekly = weekly_distinct_users(activity, F.col(WEEK) <= "1999_52")
    replace_partitions(weekly, target, [WEEK], writers=writers_for(spark, 400))
    predicate = latest(spark.read.parquet(target), [WEEK])
    return weekly_distinct_users(activity, predicate)


def _two_key_target(spark, sf_dir):
    activity = _activity(spark, sf_dir).withColumnRenamed(STORED_WEEK, WEEK)
    target = activity.where((F.col("scenario") == 0) & (F.col(WEEK) <= "2024_03"))
    return activity, target


def q_latest_two_keys(spark, sf_dir):
    activity, target = _two_key_target(spark, sf_dir)
    return activity.where(latest(target, ["scenario", WEEK]))


def q_latest_two_keys_tuple(spark, sf_dir):
    activity, target = _two_key_target(spark, sf_dir)
    return activity.where(latest(target, ["scenario", WEEK], tuple_order=True))


def q_latest_partition(spark, sf_dir):
    return latest_partition(_orders_activity(spark, sf_dir).withColumnRenamed(STORED_WEEK, WEEK), [WEEK])


# --------------------------------------------------------------------------
# Cherry-pick

# Fixed request of the cherry-pick queries.
REQUESTED_WEEKS = ["2024_01", "2024_04"]
REQUESTED_PAIRS = [
    {WEEK: "2024_01", "activity_type": "click"},
    {WEEK: "2024_02", "activity_type": "view"},
]


def q_weekly_users_cherry_pick(spark, sf_dir):
    return weekly_distinct_users(_activity(spark, sf_dir), cherry_pick({WEEK: REQUESTED_WEEKS}))


def _null_typed(df: DataFrame, null_type: str) -> DataFrame:
    return df.select(
        F.col(STORED_WEEK).alias(WEEK),
        F.when(F.col("activity_type") != null_type, F.col("activity_type")).alias("activity_type"),
    )


def _count_pairs(df: DataFrame) -> DataFrame:
    return df.groupBy(WEEK, "activity_type").agg(F.count(F.lit(1)).alias("events"))


def q_cherry_pick_tuples_null(spark, sf_dir):
    rows = _null_typed(_activity(spark, sf_dir), "error")
    return _count_pairs(rows.where(cherry_pick(REQUESTED_PAIRS)))


def _iso_weeks(years):
    """Every possible ISO week key of the given years (weeks 01..53)."""
    return [f"{y}_{w:02d}" for y in years for w in range(1, 54)]


def q_cherry_pick_many(spark, sf_dir):
    request = {WEEK: _iso_weeks([1996, 1998])}  # 106 keys: hash-set membership
    return weekly_distinct_users(_orders_activity(spark, sf_dir), cherry_pick(request))


def q_cherry_pick_many_tuples_null(spark, sf_dir):
    request = [{WEEK: w, "activity_type": t} for w in _iso_weeks([1997]) for t in ("1-URGENT", "2-HIGH")]
    rows = _null_typed(_orders_activity(spark, sf_dir), "5-LOW")
    return _count_pairs(rows.where(cherry_pick(request)))


def _stored_orders(spark, sf_dir):
    """Orders activity as a table partitioned by week."""
    path = fresh_dir(spark, "stored_orders")
    overwrite_all(_orders_activity(spark, sf_dir), path, [STORED_WEEK], rebalance=True)
    return spark.read.parquet(path).withColumnRenamed(STORED_WEEK, WEEK)


def _picked(spark, sf_dir, tuples):
    """Key tuples on the stored, partitioned table: reads the weeks requested only."""
    types = ("1-URGENT", "2-HIGH", "3-MEDIUM")
    request = [{WEEK: w, "activity_type": types[i % 3]} for i, w in enumerate(_iso_weeks([1995, 1996, 1997])[:tuples])]
    return _count_pairs(_stored_orders(spark, sf_dir).where(cherry_pick(request)))


def q_cherry_pick_stored_11(spark, sf_dir):
    return _picked(spark, sf_dir, 11)


def q_cherry_pick_stored_53(spark, sf_dir):
    return _picked(spark, sf_dir, 53)


def q_cherry_pick_stored_156(spark, sf_dir):
    return _picked(spark, sf_dir, 156)


def q_literal_rows(spark, sf_dir):
    # Literal rows as a DataFrame: a request of week and type, as data.
    request = requests_frame(spark, REQUESTED_PAIRS, f"{WEEK} string, activity_type string")
    rows = _activity(spark, sf_dir).withColumnRenamed(STORED_WEEK, WEEK)
    return _count_pairs(select_partitions(rows, request))


def q_strategy_by_name(spark, sf_dir):
    # The three strategies by name, each selecting from the same table.
    activity = _activity(spark, sf_dir).withColumnRenamed(STORED_WEEK, WEEK)
    target = activity.where(F.col(WEEK) <= "2024_03")
    chosen = {
        "latest": strategy("LATEST", target, [WEEK]),
        "cherry_pick": strategy("cherry_pick", {WEEK: REQUESTED_WEEKS}),
        "trivial": strategy(" Trivial "),
    }
    counts = [
        activity.where(p).groupBy(WEEK).agg(F.count(F.lit(1)).alias("events")).withColumn("strategy", F.lit(name))
        for name, p in chosen.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def q_keep_requested_join(spark, sf_dir):
    rows = _null_typed(_orders_activity(spark, sf_dir), "5-LOW")
    requests = rows.where(
        (F.substring(WEEK, 1, 4) == "1997") & F.col("activity_type").isin("1-URGENT", "2-HIGH")
    )
    return _count_pairs(keep_requested(rows, requests, [WEEK, "activity_type"]))


# --------------------------------------------------------------------------
# Sinks and the overwrite job


def q_overwrite_all(spark, sf_dir):
    landing = spark.read.parquet(_landing(spark, sf_dir))
    target = fresh_dir(spark, "user_activity")
    overwrite_all(landing.where(F.col("scenario") == 0), target, [STORED_WEEK])
    overwrite_all(landing.where(F.col("scenario") == 1), target, [STORED_WEEK])
    return spark.read.parquet(target).select(*ACTIVITY_COLS)


def _replaced_weeks(spark, sf_dir, fmt):
    landing = _landing(spark, sf_dir)
    warehouse, schema = _warehouse(spark)
    job = {"landing": landing, "warehouse": warehouse, "schema": schema, "fmt": fmt}
    run_overwrite(spark, scenario=0, backfill=True, **job)
    request = '{"year_woy": ["2024_01", "2024_03"]}'
    for _ in range(2):  # a re-run leaves the same table
        run_overwrite(spark, scenario=1, partitions=request, **job)
    return _daily(spark, warehouse, schema, fmt)


def q_replace_partitions(spark, sf_dir):
    return _replaced_weeks(spark, sf_dir, "parquet")


def q_replace_partitions_orc(spark, sf_dir):
    return _replaced_weeks(spark, sf_dir, "orc")


def q_replace_partitions_orders(spark, sf_dir):
    landing = _landing(spark, sf_dir, source=_orders_activity, files=8)
    warehouse, schema = _warehouse(spark)
    run_overwrite(spark, landing=landing, warehouse=warehouse, schema=schema, scenario=0, backfill=True)
    request = {WEEK: _iso_weeks([1997])}  # 53 weeks: hash-set membership, pruned scan
    run_overwrite(spark, landing=landing, warehouse=warehouse, schema=schema, scenario=1, partitions=request)
    return _daily(spark, warehouse, schema)


def q_second_target(spark, sf_dir):
    # Another registered target: two partition keys, repaired by key tuples.
    landing = _landing(spark, sf_dir)
    warehouse, schema = _warehouse(spark)
    job = {"landing": landing, "warehouse": warehouse, "schema": schema, "table": "weekly_types"}
    run_overwrite(spark, scenario=0, backfill=True, **job)
    run_overwrite(spark, scenario=1, partitions=REQUESTED_PAIRS, **job)
    return spark.table(f"{schema}.weekly_types").select(WEEK, "activity_type", "events")


def q_job_catalog(spark, sf_dir):
    # The second load holds fewer weeks: the activity table loses the others,
    # in the catalog too, and the weekly table keeps them.
    warehouse, schema = _warehouse(spark)
    job = {"warehouse": warehouse, "schema": schema, "backfill": True}
    run_overwrite(spark, landing=_landing(spark, sf_dir), scenario=0, **job)
    run_overwrite(spark, landing=_landing(spark, sf_dir, F.col(STORED_WEEK) <= "2024_03"), scenario=1, **job)
    activity = spark.table(f"{schema}.user_activity").groupBy(F.col(STORED_WEEK).alias(WEEK)).agg(
        F.count(F.lit(1)).alias("events"), F.max("scenario").alias("scenario")
    )
    return spark.table(f"{schema}.daily_activity").join(activity, WEEK, "left").select(
        WEEK, "distinct_daily_users", "events", "scenario"
    )


def q_replace_keeps_stale(spark, sf_dir):
    activity = _activity(spark, sf_dir)
    target = fresh_dir(spark, "weekly")
    replace_partitions(weekly_distinct_users(activity), target, [WEEK])
    fresh = activity.where((F.col("scenario") == 2) & (F.col(STORED_WEEK) != "2024_02"))
    replace_partitions(weekly_distinct_users(fresh), target, [WEEK])
    return _weekly(spark.read.parquet(target))


def q_latest_job(spark, sf_dir):
    # First landing holds weeks up to 2024_03; the second run sees all weeks
    # but, in latest mode, recomputes only weeks after 2024_03.
    early = _landing(spark, sf_dir, F.col(STORED_WEEK) <= "2024_03")
    full = _landing(spark, sf_dir)
    warehouse, schema = _warehouse(spark)
    run_overwrite(spark, landing=early, warehouse=warehouse, schema=schema, scenario=0, backfill=True)
    run_overwrite(spark, landing=full, warehouse=warehouse, schema=schema, scenario=1)
    return _daily(spark, warehouse, schema)


def q_write_audit(spark, sf_dir):
    landing = _landing(spark, sf_dir)
    warehouse, schema = _warehouse(spark)
    audit = fresh_dir(spark, "audit")
    run_overwrite(spark, landing=landing, warehouse=warehouse, schema=schema, scenario=1, backfill=True, audit=audit)
    tables = [table_history(spark, audit, t) for t in ("user_activity", "daily_activity")]
    return tables[0].unionByName(tables[1]).select("table_name", "rows", "partitions_after")


def q_table_partitions(spark, sf_dir):
    # The catalog's partition columns and listing of the table the job loaded.
    warehouse, schema = _warehouse(spark)
    run_overwrite(spark, landing=_landing(spark, sf_dir), warehouse=warehouse, schema=schema, scenario=0, backfill=True)
    name = f"{schema}.user_activity"
    listed = table_partitions(spark, name)
    return listed.select(F.lit(",".join(partition_columns(spark, name))).alias("partition_columns"), F.col(STORED_WEEK).alias(WEEK))


def q_job_tables(spark, sf_dir):
    # Every table of the job is created empty, then filled through the catalog.
    warehouse, schema = _warehouse(spark)
    names = ("user_activity", "daily_activity")
    definitions = {t: table_definition("idempotent", t) for t in names}
    ensure_tables(spark, dict.fromkeys(names, schema), warehouse, definitions)
    empty = {t: spark.table(f"{schema}.{t}").isEmpty() for t in names}
    rows = _activity(spark, sf_dir).drop("scenario").select(*definitions["user_activity"].schema.fieldNames())
    rows.write.insertInto(f"{schema}.user_activity", overwrite=True)
    stored = spark.table(f"{schema}.user_activity")
    weekly_distinct_users(stored).select("distinct_daily_users", WEEK).write.insertInto(f"{schema}.daily_activity", overwrite=True)
    return spark.table(f"{schema}.daily_activity").select(
        WEEK, "distinct_daily_users", F.lit(empty["user_activity"] and empty["daily_activity"]).alias("created_empty")
    )


def q_table_exists(spark, sf_dir):
    # One row per week of the written table, with what the probes said before and after the write.
    path = fresh_dir(spark, "probe")
    before = table_exists(spark, path=path)
    replace_partitions(weekly_distinct_users(_activity(spark, sf_dir)), path, [WEEK])
    return _weekly(spark.read.parquet(path)).withColumns({"before": F.lit(before), "after": F.lit(table_exists(spark, path=path))})


def q_sink_spec(spark, sf_dir):
    # A described sink, in each of its modes.
    sink = {"name": "weekly", "location": fresh_dir(spark, "sink"), "partitions": [WEEK], "options": {"compression": "zstd"}}
    activity = _activity(spark, sf_dir)
    write_sink(weekly_distinct_users(activity.where("scenario = 0")), sink, "overwrite")
    write_sink(weekly_distinct_users(activity.where("scenario = 1"), F.col(WEEK) <= "2024_02"), sink, "replace")
    write_sink(weekly_distinct_users(activity.where("scenario = 2"), F.col(WEEK) == "2024_01"), sink, "append")
    return _weekly(spark.read.parquet(sink["location"]))


# --------------------------------------------------------------------------
# Append, weekly view, roll-over days


def q_append_twice(spark, sf_dir):
    src = fresh_dir(spark, "weekly_src")
    weekly_distinct_users(_activity(spark, sf_dir)).write.parquet(src)
    name = f"tm_append_{os.path.basename(src).replace('-', '_')}"
    path = fresh_dir(spark, "appended")
    for _ in range(2):  # deliberately not idempotent
        read_preview_append(spark, src, name, path, n=5)
    return _weekly(spark.table(name))


def q_weekly_view(spark, sf_dir):
    landing = spark.read.parquet(_landing(spark, sf_dir))
    location = fresh_dir(spark, "user_activity")
    overwrite_all(landing.drop("scenario"), location, [STORED_WEEK])
    schema = f"tm_{os.path.basename(location).replace('-', '_')}"
    weekly_table_and_view(
        spark,
        schema=schema,
        table="user_activity",
        view="weekly_2024_01",
        week="2024_01",
        location=location,
        schema_location=f"{location}_schema",
    )
    return spark.table(f"{schema}.weekly_2024_01")


def q_period_rollover(spark, sf_dir):
    return rollover_days(_activity(spark, sf_dir))


def q_period_rollover_orders(spark, sf_dir):
    return rollover_days(_orders_activity(spark, sf_dir))


# --------------------------------------------------------------------------
# Configured sources


# Spark's default timestamp text keeps milliseconds only.
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _source_roundtrip(spark, sf_dir, fmt):
    """All of ``events``, written as several files and read back as a configured source."""
    path = fresh_dir(spark, f"src_{fmt}")
    events = _events(spark, sf_dir)
    options = {"timestampNTZFormat": MICROSECONDS, "timestampFormat": MICROSECONDS} if fmt == "csv" else {}
    if fmt == "csv":
        options |= {"quoteAll": "true", "escape": '"', "multiLine": "true"}
    events.repartition(4).write.format(fmt).options(**options).save(path)
    config = {
        "defaults": {"ignored": True},
        fmt: {"events": {"path": path, "schema": events.schema.jsonValue(), "options": options | ({"mode": "FAILFAST"} if fmt == "csv" else {})}},
    }
    return read_catalog(spark, config)["events"]


def q_source_csv(spark, sf_dir):
    return _source_roundtrip(spark, sf_dir, "csv")


def q_source_parquet(spark, sf_dir):
    return _source_roundtrip(spark, sf_dir, "parquet")


# --------------------------------------------------------------------------
# Stream-driven replacement


def q_stream_replace(spark, sf_dir):
    landing = fresh_dir(spark, "stream_landing")
    activity = _activity(spark, sf_dir)
    # Several files, so the stream runs several micro-batches.
    activity.repartitionByRange(4, "activity_date").write.parquet(landing)
    store = fresh_dir(spark, "stream_store")
    target = fresh_dir(spark, "stream_weekly")
    query = start_replace_stream(
        spark,
        landing=landing,
        schema=activity.schema,
        store=store,
        target=target,
        checkpoint=fresh_dir(spark, "stream_ckpt"),
        files_per_batch=1,
    )
    query.awaitTermination()
    return _weekly(spark.read.parquet(target))


def q_stream_replace_orders(spark, sf_dir):
    # Files hashed on the customer: every micro-batch touches most weeks, so
    # each week must be recomputed from everything stored so far. Four files,
    # two per micro-batch.
    landing = fresh_dir(spark, "stream_landing")
    activity = _orders_activity(spark, sf_dir)
    activity.repartition(4, "user_id").write.parquet(landing)
    target = fresh_dir(spark, "stream_weekly")
    query = start_replace_stream(
        spark,
        landing=landing,
        schema=activity.schema,
        store=fresh_dir(spark, "stream_store"),
        target=target,
        checkpoint=fresh_dir(spark, "stream_ckpt"),
        files_per_batch=2,
    )
    query.awaitTermination()
    return _weekly(spark.read.parquet(target))


def q_stream_two_checkpoints(spark, sf_dir):
    # Two streams, each with its own landing and checkpoint, into one store.
    store, target = fresh_dir(spark, "stream_store"), fresh_dir(spark, "stream_weekly")
    activity = _activity(spark, sf_dir)
    for part in (0, 1):
        landing = fresh_dir(spark, "stream_landing")
        activity.where(F.pmod(F.xxhash64("user_id", "activity_date"), F.lit(2)) == part).write.parquet(landing)
        start_replace_stream(
            spark, landing=landing, schema=activity.schema, store=store, target=target, checkpoint=fresh_dir(spark, "stream_ckpt")
        ).awaitTermination()
    return _weekly(spark.read.parquet(target))


def q_stream_interleaved(spark, sf_dir):
    # Two runs take turns, each with two thirds of the events. In every round both compare
    # with the store before either writes, so both add the pairs they share; then both
    # write, count, and (in between) a week is compacted. The first run's first batch is
    # replayed at the end.
    store, target = fresh_dir(spark, "stream_store"), fresh_dir(spark, "stream_weekly")
    activity = _activity(spark, sf_dir)
    third = F.pmod(F.xxhash64("user_id", "activity_date", "activity_type"), F.lit(3))
    batches = [activity.where((third != part) & (F.col(STORED_WEEK) <= "2024_03" if i == 0 else F.col(STORED_WEEK) > "2024_02")) for i in (0, 1) for part in (0, 1)]
    for i in (0, 1):
        turn = []
        for run, batch in zip("ab", batches[2 * i : 2 * i + 2]):
            pairs = batch_pairs(batch)
            weeks = [r[0] for r in pairs.select(WEEK).distinct().collect()]
            turn.append((weeks, new_pairs(spark, pairs, weeks, i, run=run, store=store)))
        for _, rows in turn:
            write_pairs(rows, store)
        for weeks, _ in turn:
            recount_weeks(spark, weeks, store=store, target=target)
        compact_weeks(spark, store, ["2024_02", "2024_03"])
    replace_batch(spark, batches[0], 0, run="a", store=store, target=target)
    return _weekly(spark.read.parquet(target))


# --------------------------------------------------------------------------
# Partition-scoped cost: dynamic pruning, bitmaps, buckets, versions, fingerprints, views, rejects


def q_request_as_data(spark, sf_dir):
    # Two weeks of the stored table, requested as data: their folders are the only ones read.
    request = requests_frame(spark, {WEEK: ["1995_10", "2001_20"]})
    return _count_pairs(keep_requested(_stored_orders(spark, sf_dir), request, [WEEK]))


def q_weekly_users_bitmaps(spark, sf_dir):
    # The bitmaps of one scenario, then the rows of the others merged in, one of them twice.
    store, activity = fresh_dir(spark, "bitmaps"), _orders_activity(spark, sf_dir)
    for scenario in (0, 1, 2, 1):
        add_to_bitmaps(spark, activity.where(F.col("scenario") == scenario), store)
    return bitmap_counts(spark.read.parquet(store))


def q_weekly_users_bucketed(spark, sf_dir):
    path = fresh_dir(spark, "bucketed")
    name = f"tm_{os.path.basename(path).replace('-', '_')}"
    write_bucketed(_activity(spark, sf_dir), name, path, 8)
    return weekly_distinct_users(spark.table(name))


def q_published_loads(spark, sf_dir):
    # Each load is a version of its own; the name moves from one to the next. The second
    # landing holds fewer weeks, so the activity table does too, and the weekly table keeps the others.
    warehouse, schema = _warehouse(spark)
    job = {"warehouse": warehouse, "schema": schema, "backfill": True, "load_mode": "publish"}
    run_overwrite(spark, landing=_landing(spark, sf_dir), scenario=0, **job)
    run_overwrite(spark, landing=_landing(spark, sf_dir, F.col(STORED_WEEK) <= "2024_03"), scenario=1, **job)
    activity = spark.table(f"{schema}.user_activity").groupBy(F.col(STORED_WEEK).alias(WEEK)).agg(F.count(F.lit(1)).alias("events"))
    return spark.table(f"{schema}.daily_activity").join(activity, WEEK, "left").select(WEEK, "distinct_daily_users", "events")


def q_changed_weeks(spark, sf_dir):
    # Four loads: all weeks; the same again, in other files; one week changed; the same again.
    warehouse, schema = _warehouse(spark)
    activity = _activity(spark, sf_dir)
    changed = activity.withColumn("user_id", F.when(F.col(STORED_WEEK) == "2024_04", F.col("user_id") % 10).otherwise(F.col("user_id")))
    written = []
    for rows in (activity, activity.orderBy("user_id"), changed, changed):
        landing = fresh_dir(spark, "landing")
        rows.write.parquet(landing)
        done = run_overwrite(spark, landing=landing, warehouse=warehouse, schema=schema, scenario=0, load_mode="changed")
        written.append(done["rows"])
    return _daily(spark, warehouse, schema).withColumn("weeks_written", F.lit(",".join(map(str, written[1:]))))


def q_due_views(spark, sf_dir):
    # Views of the due weeks after two runs: the second landing lacks a week that the first had.
    warehouse, schema = _warehouse(spark)
    job = {"warehouse": warehouse, "schema": schema, "scenario": 0, "backfill": True}
    due = due_weeks(_activity(spark, sf_dir))
    for where in (F.col(STORED_WEEK) <= "2024_03", F.col(STORED_WEEK) != "2024_02"):
        run_overwrite(spark, landing=_landing(spark, sf_dir, where), **job)
        maintain_weekly_views(spark, schema=schema, table="user_activity", due=due)
    names = sorted(r.viewName for r in spark.sql(f"SHOW VIEWS IN {schema}").collect())
    counts = [spark.table(f"{schema}.{n}").agg(F.count(F.lit(1)).alias("events")).withColumn("view", F.lit(n)) for n in names]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def q_source_rejects(spark, sf_dir):
    # All of events as CSV lines, every tenth with a user that is no number: good rows,
    # raw bad ones, and both counts from the one pass that read them.
    path = fresh_dir(spark, "raw_csv")
    user = F.concat(F.when(F.col("event_id") % 10 == 0, F.lit("x")).otherwise(F.lit("")), F.col("user_id"))
    _events(spark, sf_dir).select(F.concat_ws(",", "event_id", user, "event_type")).write.text(path)
    source = parse_source("csv", "raw", {"path": path, "schema": "event_id long, user_id long, event_type string"})
    staged = stage_source(spark, source, fresh_dir(spark, "staged"))
    counts = {k: F.lit(staged[k]).cast("long") for k in ("rows", "rejected")}
    good = staged["good"].withColumn("record", F.lit(None).cast("string"))
    bad = staged["bad"].select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in staged["good"].schema.fields), "record")
    return good.unionByName(bad).withColumns(counts)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_scenario": q_scan_scenario,
    "weekly_users_backfill": q_weekly_users_backfill,
    "weekly_users_backfill_orders": q_weekly_users_backfill_orders,
    "weekly_users_latest": q_weekly_users_latest,
    "weekly_users_latest_orders": q_weekly_users_latest_orders,
    "weekly_users_cherry_pick": q_weekly_users_cherry_pick,
    "cherry_pick_tuples_null": q_cherry_pick_tuples_null,
    "cherry_pick_many": q_cherry_pick_many,
    "cherry_pick_many_tuples_null": q_cherry_pick_many_tuples_null,
    "cherry_pick_stored_11": q_cherry_pick_stored_11,
    "cherry_pick_stored_53": q_cherry_pick_stored_53,
    "cherry_pick_stored_156": q_cherry_pick_stored_156,
    "literal_rows": q_literal_rows,
    "strategy_by_name": q_strategy_by_name,
    "keep_requested_join": q_keep_requested_join,
    "latest_two_keys": q_latest_two_keys,
    "latest_two_keys_tuple": q_latest_two_keys_tuple,
    "latest_partition": q_latest_partition,
    "overwrite_all": q_overwrite_all,
    "replace_partitions": q_replace_partitions,
    "replace_partitions_orc": q_replace_partitions_orc,
    "replace_partitions_orders": q_replace_partitions_orders,
    "second_target": q_second_target,
    "job_catalog": q_job_catalog,
    "replace_keeps_stale": q_replace_keeps_stale,
    "latest_job": q_latest_job,
    "write_audit": q_write_audit,
    "table_partitions": q_table_partitions,
    "job_tables": q_job_tables,
    "table_exists": q_table_exists,
    "sink_spec": q_sink_spec,
    "append_twice": q_append_twice,
    "weekly_view": q_weekly_view,
    "period_rollover": q_period_rollover,
    "period_rollover_orders": q_period_rollover_orders,
    "source_csv": q_source_csv,
    "source_parquet": q_source_parquet,
    "stream_replace": q_stream_replace,
    "stream_replace_orders": q_stream_replace_orders,
    "stream_two_checkpoints": q_stream_two_checkpoints,
    "stream_interleaved": q_stream_interleaved,
    "request_as_data": q_request_as_data,
    "weekly_users_bitmaps": q_weekly_users_bitmaps,
    "weekly_users_bucketed": q_weekly_users_bucketed,
    "published_loads": q_published_loads,
    "changed_weeks": q_changed_weeks,
    "due_views": q_due_views,
    "source_rejects": q_source_rejects,
}


# --------------------------------------------------------------------------
# Oracles (DuckDB)

_UA = (
    "WITH ua AS (SELECT user_id, CAST(ts AS DATE) AS activity_date, "
    "event_type AS activity_type, strftime(ts, '%G_%V') AS year_woy, "
    "CAST(event_id % 3 AS INTEGER) AS scenario FROM events) "
)
_UO = (
    "WITH ua AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS activity_date, "
    "o_orderpriority AS activity_type, strftime(o_orderdate, '%G_%V') AS year_woy, "
    "CAST(o_orderkey % 3 AS INTEGER) AS scenario FROM orders) "
)


def _wau(cond: str, cte: str = _UA) -> str:
    return (
        cte + "SELECT year_woy, CAST(COUNT(DISTINCT user_id) AS INTEGER) AS distinct_daily_users "
        f"FROM ua WHERE {cond} GROUP BY year_woy"
    )


def _replaced(base: str, new: str, cte: str = _UA) -> str:
    """Weekly table after a base write and a dynamic replacement.

    A week the replacement produced takes its new value; every other week
    keeps its base value (a partition absent from the new output stays).
    """
    return (
        cte + f", b AS (SELECT year_woy, COUNT(DISTINCT user_id) AS n FROM ua WHERE {base} GROUP BY year_woy), "
        f"r AS (SELECT year_woy, COUNT(DISTINCT user_id) AS n FROM ua WHERE {new} GROUP BY year_woy) "
        "SELECT year_woy, CAST(COALESCE(r.n, b.n) AS INTEGER) AS distinct_daily_users "
        "FROM b FULL OUTER JOIN r USING (year_woy)"
    )


_ROWS = (
    "SELECT user_id, activity_date, activity_type, year_woy AS __year_week_of_year__, scenario FROM ua "
)
_ROWS_WEEK = "SELECT user_id, activity_date, activity_type, year_woy, scenario FROM ua "


def _pairs(cte: str, null_type: str, cond: str) -> str:
    return (
        cte + ", t AS (SELECT year_woy, CASE WHEN activity_type <> "
        f"'{null_type}' THEN activity_type END AS activity_type FROM ua) "
        f"SELECT year_woy, activity_type, COUNT(*) AS events FROM t WHERE {cond} "
        "GROUP BY year_woy, activity_type"
    )


def _rollover(cte: str) -> str:
    return (
        cte + "SELECT DISTINCT activity_date AS rollover_date FROM ua "
        "WHERE isodow(activity_date) = 1 OR (month(activity_date) = 1 AND day(activity_date) = 1)"
    )


def _picked_sql(tuples: int) -> str:
    types = ("1-URGENT", "2-HIGH", "3-MEDIUM")
    pairs = ", ".join(f"('{w}', '{types[i % 3]}')" for i, w in enumerate(_iso_weeks([1995, 1996, 1997])[:tuples]))
    return _UO + f"SELECT year_woy, activity_type, COUNT(*) AS events FROM ua WHERE (year_woy, activity_type) IN ({pairs}) GROUP BY ALL"


_ORACLES: dict[str, str] = {
    "scan_scenario": _UA + _ROWS + "WHERE scenario = 0",
    "weekly_users_backfill": _wau("TRUE"),
    "weekly_users_backfill_orders": _wau("TRUE", _UO),
    "weekly_users_latest": _wau("year_woy IS NULL OR year_woy > '2024_03'"),
    "weekly_users_latest_orders": _wau("year_woy IS NULL OR year_woy > '1999_52'", _UO),
    "weekly_users_cherry_pick": _wau("year_woy IS NULL OR year_woy IN ('2024_01', '2024_04')"),
    "cherry_pick_tuples_null": _pairs(
        _UA,
        "error",
        "((year_woy IS NULL OR year_woy = '2024_01') AND (activity_type IS NULL OR activity_type = 'click')) "
        "OR ((year_woy IS NULL OR year_woy = '2024_02') AND (activity_type IS NULL OR activity_type = 'view'))",
    ),
    "cherry_pick_many": _wau("year_woy IS NULL OR substr(year_woy, 1, 4) IN ('1996', '1998')", _UO),
    "cherry_pick_many_tuples_null": _pairs(
        _UO,
        "5-LOW",
        "(year_woy IS NULL OR substr(year_woy, 1, 4) = '1997') "
        "AND (activity_type IS NULL OR activity_type IN ('1-URGENT', '2-HIGH'))",
    ),
    **{f"cherry_pick_stored_{n}": _picked_sql(n) for n in (11, 53, 156)},
    "literal_rows": _pairs(
        _UA,
        "",
        "(year_woy = '2024_01' AND activity_type = 'click') OR (year_woy = '2024_02' AND activity_type = 'view')",
    ),
    "strategy_by_name": _UA + " UNION ALL ".join(
        f"SELECT '{name}' AS strategy, year_woy, COUNT(*) AS events FROM ua WHERE {cond} GROUP BY year_woy"
        for name, cond in (("latest", "year_woy > '2024_03'"), ("cherry_pick", "year_woy IN ('2024_01', '2024_04')"), ("trivial", "TRUE"))
    ),
    "keep_requested_join": _pairs(
        _UO,
        "5-LOW",
        "EXISTS (SELECT 1 FROM (SELECT year_woy AS rw, activity_type AS rt FROM ua "
        "WHERE substr(year_woy, 1, 4) = '1997' AND activity_type IN ('1-URGENT', '2-HIGH')) r "
        "WHERE (t.year_woy IS NULL OR t.year_woy = r.rw) AND (t.activity_type IS NULL OR t.activity_type = r.rt))",
    ),
    "latest_two_keys": _UA + _ROWS_WEEK + "WHERE (scenario IS NULL OR scenario > 0) "
    "AND (year_woy IS NULL OR year_woy > '2024_03')",
    "latest_two_keys_tuple": _UA + _ROWS_WEEK + "WHERE scenario IS NULL OR year_woy IS NULL "
    "OR scenario > 0 OR (scenario = 0 AND year_woy > '2024_03')",
    "latest_partition": _UO + "SELECT year_woy FROM ua ORDER BY year_woy DESC NULLS LAST LIMIT 1",
    "overwrite_all": _UA + _ROWS + "WHERE scenario = 1",
    "replace_partitions": _replaced(
        "scenario = 0", "scenario = 1 AND (year_woy IS NULL OR year_woy IN ('2024_01', '2024_03'))"
    ),
    "replace_partitions_orders": _replaced(
        "scenario = 0", "scenario = 1 AND (year_woy IS NULL OR substr(year_woy, 1, 4) = '1997')", _UO
    ),
    "replace_keeps_stale": _replaced("TRUE", "scenario = 2 AND year_woy <> '2024_02'"),
    "latest_job": _wau("scenario = CASE WHEN year_woy <= '2024_03' THEN 0 ELSE 1 END"),
    "replace_partitions_orc": _replaced("scenario = 0", "scenario = 1 AND year_woy IN ('2024_01', '2024_03')"),
    "second_target": _UA + "SELECT year_woy, activity_type, COUNT(*) AS events FROM ua "
    "WHERE scenario = CASE WHEN (year_woy, activity_type) IN (('2024_01', 'click'), ('2024_02', 'view')) THEN 1 ELSE 0 END "
    "GROUP BY year_woy, activity_type",
    "job_catalog": _UA + "SELECT year_woy, CAST(COUNT(DISTINCT user_id) AS INTEGER) AS distinct_daily_users, "
    "CASE WHEN year_woy <= '2024_03' THEN COUNT(*) END AS events, CASE WHEN year_woy <= '2024_03' THEN 1 END AS scenario "
    "FROM ua WHERE scenario = CASE WHEN year_woy <= '2024_03' THEN 1 ELSE 0 END GROUP BY year_woy",
    "write_audit": _UA + "SELECT 'user_activity' AS table_name, COUNT(*) AS rows, COUNT(DISTINCT year_woy) AS partitions_after "
    "FROM ua WHERE scenario = 1 UNION ALL SELECT 'daily_activity', COUNT(DISTINCT year_woy), COUNT(DISTINCT year_woy) FROM ua WHERE scenario = 1",
    "table_partitions": _UA + "SELECT DISTINCT '__year_week_of_year__' AS partition_columns, year_woy FROM ua WHERE scenario = 0",
    "job_tables": f"SELECT *, TRUE AS created_empty FROM ({_wau('TRUE')})",
    "table_exists": f"SELECT *, FALSE AS before, TRUE AS after FROM ({_wau('TRUE')})",
    "sink_spec": _replaced("scenario = 0", "scenario = 1 AND year_woy <= '2024_02'")
    + f" UNION ALL SELECT * FROM ({_wau(chr(39).join(('scenario = 2 AND year_woy = ', '2024_01', '')))})",
    "append_twice": f"SELECT * FROM ({_wau('TRUE')}) UNION ALL SELECT * FROM ({_wau('TRUE')})",
    "weekly_view": _UA + "SELECT user_id, activity_date, activity_type FROM ua WHERE year_woy = '2024_01'",
    "period_rollover": _rollover(_UA),
    "period_rollover_orders": _rollover(_UO),
    "source_csv": "SELECT * FROM events",
    "source_parquet": "SELECT * FROM events",
    "stream_replace": _wau("TRUE"),
    "stream_replace_orders": _wau("TRUE", _UO),
    "stream_two_checkpoints": _wau("TRUE"),
    "stream_interleaved": _wau("TRUE"),
    "request_as_data": _UO + "SELECT year_woy, activity_type, COUNT(*) AS events FROM ua WHERE year_woy IN ('1995_10', '2001_20') GROUP BY ALL",
    "weekly_users_bitmaps": _wau("TRUE", _UO),
    "weekly_users_bucketed": _wau("TRUE"),
    "published_loads": _UA + "SELECT year_woy, CAST(COUNT(DISTINCT user_id) AS INTEGER) AS distinct_daily_users, "
    "CASE WHEN year_woy <= '2024_03' THEN COUNT(*) END AS events "
    "FROM ua WHERE scenario = CASE WHEN year_woy <= '2024_03' THEN 1 ELSE 0 END GROUP BY year_woy",
    "changed_weeks": _UA + "SELECT year_woy, CAST(COUNT(DISTINCT CASE WHEN year_woy = '2024_04' THEN user_id % 10 ELSE user_id END) AS INTEGER) "
    "AS distinct_daily_users, '0,1,0' AS weeks_written FROM ua WHERE scenario = 0 GROUP BY year_woy",
    "due_views": _UA + "SELECT 'weekly_' || year_woy AS view, COUNT(*) AS events FROM ua WHERE scenario = 0 AND year_woy <> '2024_02' "
    "AND year_woy IN (SELECT year_woy FROM ua WHERE isodow(activity_date) = 1 OR (month(activity_date) = 1 AND day(activity_date) = 1)) GROUP BY year_woy",
    "source_rejects": "WITH n AS (SELECT COUNT(*) FILTER (event_id % 10 <> 0) AS rows, COUNT(*) FILTER (event_id % 10 = 0) AS rejected FROM events) "
    "SELECT CASE WHEN event_id % 10 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id, "
    "CASE WHEN event_id % 10 <> 0 THEN event_type END AS event_type, "
    "CASE WHEN event_id % 10 = 0 THEN event_id || ',x' || user_id || ',' || event_type END AS record, rows, rejected FROM events, n",
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: exact distinct users per ISO week over sf0.001 ``events``."""
    return q_weekly_users_backfill(spark, "/root/testdata/sf0.001")


def _training_data():
    """Queries and SQL of the ``llm`` subpackage and the corpus pipeline, where they are installed."""
    found, sql = {}, {}
    try:
        from tidemark.llm import queries as llm

        found, sql = dict(llm.QUERIES), dict(llm.ORACLES)
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ImportError as e:
        # Not installed: the module is missing, or its folder has been left with nothing but compiled files.
        left = os.path.join(os.path.dirname(os.path.abspath(__file__)), "tidemark", "llm", "__init__.py")
        if os.path.exists(left) and not (isinstance(e, ModuleNotFoundError) and e.name == "corpus_pipeline"):
            raise  # it is there but broken
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**_ORACLES, **_training_data()[1]}
