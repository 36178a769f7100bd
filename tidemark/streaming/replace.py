"""Stream-driven partition replacement.

The store keeps (week, user) pairs, partitioned by week, run and micro-batch. A
micro-batch adds the pairs that the touched weeks do not have yet, and the
weekly table gets those weeks' new counts of distinct users.

Only the folders of the touched weeks are looked at: they are listed by name,
week by week, and read by path. A week with more than ``compact_after`` folders is
folded into one, so what a batch lists and reads does not grow with the
number of batches before it.

Any number of streams may share a store, and each micro-batch may be replayed:

* a run is a checkpoint, known by the id Spark keeps in it, so no stream writes
  another's folders, and a replayed batch rewrites its own;
* pairs are counted distinct, so two streams that both add a pair, each before
  the other's write, count it once;
* after it has written the counts a stream lists the touched weeks again, and
  counts again if a folder has come or gone. Whoever writes a count last
  has therefore seen all pairs that were there;
* compaction deletes only folders whose pairs it has written to a new folder
  before; a stream that meets a folder just deleted lists anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.functions.weeks import STORED_WEEK, WEEK
from tidemark.operators.sinks import replace_partitions, writers_for
from tidemark.storage import partition_folder, remove_folders, subfolders

RUN, BATCH = "__run__", "__batch_id__"
COMPACT_AFTER = 24  # folders of a week
_FOLDED = "folded-"
_T = TypeVar("_T")
# Partition columns of the store, typed: a listing alone would guess.
_STORE = StructType([StructField("user_id", LongType()), *[StructField(c, StringType()) for c in (WEEK, RUN)], StructField(BATCH, LongType())])


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns ``checkpoint``, stable across its restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def week_folders(spark: SparkSession, store: str, weeks: Sequence[str | None]) -> dict[str | None, list[str]]:
    """The run and batch folders of each week; no other week of the store is listed."""
    found = {}
    for week in weeks:
        top = f"{store.rstrip('/')}/{partition_folder(spark, {WEEK: week})}"
        found[week] = [f"{top}/{run}/{batch}" for run in subfolders(spark, top) for batch in subfolders(spark, f"{top}/{run}")]
    return found


def _read(spark: SparkSession, store: str, folders: Sequence[str], fmt: str) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _STORE)
    return spark.read.schema(_STORE).option("basePath", store).format(fmt).load(list(folders))


def _folder_went(e: PySparkException) -> bool:
    return e.getCondition() in ("PATH_NOT_FOUND", "FAILED_READ_FILE.FILE_NOT_EXIST") or "FILE_NOT_EXIST" in str(e)


def _listed(action: Callable[[], _T]) -> _T:
    """``action``, which lists and reads, again as long as a folder it listed is compacted meanwhile."""
    while True:
        try:
            return action()
        except PySparkException as e:
            if not _folder_went(e):
                raise


def batch_pairs(batch: DataFrame) -> DataFrame:
    """The distinct (week, user) pairs of a micro-batch; an empty week is stored, and read, as null."""
    week = F.when(F.col(STORED_WEEK) != "", F.col(STORED_WEEK)).alias(WEEK)
    return batch.select(week, F.col("user_id").cast("long").alias("user_id")).distinct()


def new_pairs(spark: SparkSession, pairs: DataFrame, weeks: Sequence[str | None], batch_id: int, *, run: str, store: str, fmt: str = "parquet") -> DataFrame:
    """The pairs that the weeks' folders do not hold, but for the batch's own, as rows of the store."""
    own = partition_folder(spark, {RUN: run, BATCH: batch_id})
    before = [f for found in week_folders(spark, store, weeks).values() for f in found if not f.endswith(f"/{own}")]
    if before:
        stored = _read(spark, store, before, fmt).select(F.col(WEEK).alias("known_week"), F.col("user_id").alias("known_user"))
        known = F.col(WEEK).eqNullSafe(F.col("known_week")) & F.col("user_id").eqNullSafe(F.col("known_user"))
        pairs = pairs.join(stored, known, "left_anti")
    return pairs.withColumns({RUN: F.lit(run), BATCH: F.lit(batch_id).cast("long")})


def write_pairs(rows: DataFrame, store: str, fmt: str = "parquet") -> None:
    """Replace the folders that ``rows`` name. REBALANCE: AQE sizes the writer tasks, splitting a hot week."""
    replace_partitions(rows, store, [WEEK, RUN, BATCH], fmt=fmt, rebalance=True)


def recount_weeks(spark: SparkSession, weeks: Sequence[str | None], *, store: str, target: str, fmt: str = "parquet") -> None:
    """Replace the weeks' counts by those of the store, until no folder came or went meanwhile."""

    def counted() -> bool:
        seen = week_folders(spark, store, weeks)
        stored = _read(spark, store, [f for found in seen.values() for f in found], fmt)
        weekly = stored.groupBy(WEEK).agg(F.count_distinct("user_id").cast("int").alias("distinct_daily_users"))
        replace_partitions(weekly, target, [WEEK], fmt=fmt, writers=writers_for(spark, len(weeks)))
        return week_folders(spark, store, weeks) == seen

    while not _listed(counted):
        pass


def compact_weeks(spark: SparkSession, store: str, weeks: Sequence[str | None], fmt: str = "parquet") -> int:
    """Fold the folders of each week into one of distinct pairs; returns the number of folders removed.

    Safe beside running streams: a folder is removed only after its pairs stand in
    the new one, and folders that come meanwhile stay. A failure in between leaves
    pairs twice, which counts nothing twice and goes with the next compaction.
    """

    def folded() -> list[str]:
        old = {week: found for week, found in week_folders(spark, store, weeks).items() if len(found) > 1}
        if not old:
            return []
        name = f"{_FOLDED}{uuid.uuid4().hex[:12]}"
        rows = _read(spark, store, [f for found in old.values() for f in found], fmt).select(WEEK, "user_id").distinct()
        write_pairs(rows.withColumns({RUN: F.lit(name), BATCH: F.lit(0).cast("long")}), store, fmt)
        written = week_folders(spark, store, list(old))
        mine = f"/{partition_folder(spark, {RUN: name})}/"
        return [f for week, found in old.items() if any(mine in w for w in written[week]) for f in found]

    gone = _listed(folded)
    # A folded run has one folder for a week and is never written again: its parent goes too.
    remove_folders(spark, [f.rpartition("/")[0] if f"/{RUN}={_FOLDED}" in f else f for f in gone])
    return len(gone)


def replace_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    *,
    run: str,
    store: str,
    target: str,
    fmt: str = "parquet",
    compact_after: int = COMPACT_AFTER,
) -> int:
    """Add one micro-batch to the store and replace the weeks it touched; returns their number."""
    pairs = batch_pairs(batch).persist()  # the batch is read once
    try:
        # One value per week of the batch.
        weeks = [r[0] for r in pairs.select(WEEK).distinct().collect()]
        if not weeks:
            return 0
        _listed(lambda: write_pairs(new_pairs(spark, pairs, weeks, batch_id, run=run, store=store, fmt=fmt), store, fmt))
    finally:
        pairs.unpersist()
    recount_weeks(spark, weeks, store=store, target=target, fmt=fmt)
    full = [week for week, found in week_folders(spark, store, weeks).items() if len(found) > compact_after]
    if full:
        compact_weeks(spark, store, full, fmt)
    return len(weeks)


def start_replace_stream(
    spark: SparkSession,
    *,
    landing: str,
    schema: StructType,
    store: str,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    landing_fmt: str = "parquet",
    files_per_batch: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    compact_after: int = COMPACT_AFTER,
) -> StreamingQuery:
    """Start the stream from files of format ``landing_fmt`` arriving in ``landing``.

    ``available_now`` processes what is there in as many micro-batches as
    ``files_per_batch`` gives, then stops; otherwise it runs on
    ``processing_time``. ``checkpoint`` must be on shared storage. ``store``
    and ``target`` are kept in format ``fmt``; a week of the store with more than
    ``compact_after`` folders is compacted.
    """
    reader = spark.readStream.schema(schema).format(landing_fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", int(files_per_batch))

    def add(batch: DataFrame, batch_id: int) -> None:
        replace_batch(spark, batch, batch_id, run=run_id(spark, checkpoint), store=store, target=target, fmt=fmt, compact_after=compact_after)

    writer = reader.load(landing).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
