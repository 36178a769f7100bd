"""Exact distinct users that can be added to: one bitmap of user ids per week and range of ids.

A week's users are the set bits of its bitmaps, of 32,768 ids each (Spark's
``bitmap_*`` functions, 4 kB a range that holds a user). Merging is a bitwise or,
so adding rows reads the bitmaps of the weeks they touch and none of the rows
that came before, and adding the same rows again changes nothing.

Ids may be any long, negative ones too; a null user sets no bit, but its week
exists. The size follows the ranges in use: for ids that are dense (keys handed out
in turn) a week of a billion users takes 125 MB in 30,000 rows; ids spread over all
longs take 4 kB a user, for those keep the pairs (``tidemark.streaming.replace``).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tidemark.functions.weeks import STORED_WEEK, WEEK
from tidemark.operators.sinks import replace_partitions
from tidemark.storage import folder_exists, partition_folder

RANGE, BITS = "id_range", "bits"
_STORE = StructType([StructField(RANGE, LongType()), StructField(BITS, BinaryType()), StructField(WEEK, StringType())])


def week_bitmaps(activity: DataFrame, *, week_col: str = STORED_WEEK, user_col: str = "user_id") -> DataFrame:
    """``year_woy, id_range, bits`` of activity rows; combines map-side, one row a task, week and range in the shuffle.

    Null users go to a range of their own, a null, with an empty bitmap.
    """
    user = F.col(user_col).cast("long")
    week = F.when(F.col(week_col) != "", F.col(week_col)).alias(WEEK)  # an empty week is stored, and read, as null
    rows = activity.select(week, F.bitmap_bucket_number(user).alias(RANGE), F.bitmap_bit_position(user).alias("position"))
    return rows.groupBy(WEEK, RANGE).agg(F.bitmap_construct_agg("position").alias(BITS))


def merge_bitmaps(*parts: DataFrame) -> DataFrame:
    """One bitmap a week and range from those of all parts."""
    every = parts[0].select(WEEK, RANGE, BITS)
    for part in parts[1:]:
        every = every.unionAll(part.select(WEEK, RANGE, BITS))
    return every.groupBy(WEEK, RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def bitmap_counts(bitmaps: DataFrame) -> DataFrame:
    """``year_woy, distinct_daily_users``, equal to the count of distinct users."""
    return bitmaps.groupBy(WEEK).agg(F.sum(F.bitmap_count(BITS)).cast("int").alias("distinct_daily_users"))


def read_bitmaps(spark: SparkSession, store: str, weeks: Sequence[str | None]) -> DataFrame:
    """The stored bitmaps of these weeks; no other folder is listed or read."""
    folders = [f"{store.rstrip('/')}/{partition_folder(spark, {WEEK: w})}" for w in weeks]
    there = [f for f in folders if folder_exists(spark, f)]
    if not there:
        return spark.createDataFrame([], _STORE)
    return spark.read.schema(_STORE).option("basePath", store).parquet(*there)


def add_to_bitmaps(spark: SparkSession, activity: DataFrame, store: str, *, week_col: str = STORED_WEEK, user_col: str = "user_id") -> dict[str, Any]:
    """Merge activity rows into the store; returns the ``weeks`` touched.

    The store is partitioned by week and the touched weeks are replaced, staged and
    swapped by Spark's commit; a run that fails before that, or a run
    repeated, leaves the same bitmaps. One writer at a time: two that
    read the same week and write it in turn would lose the first one's users.
    """
    fresh = week_bitmaps(activity, week_col=week_col, user_col=user_col).persist()
    try:
        weeks = [r[0] for r in fresh.select(WEEK).distinct().collect()]
        if weeks:
            merged = merge_bitmaps(read_bitmaps(spark, store, weeks), fresh)
            replace_partitions(merged, store, [WEEK], rebalance=True)
    finally:
        fresh.unpersist()
    return {"weeks": sorted(weeks, key=lambda w: (w is None, w))}
