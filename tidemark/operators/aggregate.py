"""Weekly aggregates over the activity table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import everything
from tidemark.functions.weeks import STORED_WEEK, WEEK


def weekly_distinct_users(
    activity: DataFrame,
    predicate: Column | None = None,
    *,
    week_col: str = STORED_WEEK,
    user_col: str = "user_id",
) -> DataFrame:
    """Exact distinct users per week: ``year_woy, distinct_daily_users``.

    The predicate sees the projected names (``year_woy``, ``user_id``).
    Catalyst pushes it through the rename into the scan, where on a
    partitioned table it prunes week directories; only ``user_id`` is read.

    Plan: partial aggregate on (week, user) -> shuffle on (week, user) ->
    merge -> partial count per week -> shuffle of one row per week and task.
    The big shuffle is keyed by the *pair*, so one week holding a third of
    all rows still spreads over every reducer; a hot user collapses to one
    row per map task in the map-side combine. NULL users are not counted; a
    NULL week forms its own group.
    """
    return (
        activity.select(F.col(week_col).alias(WEEK), F.col(user_col).alias("user_id"))
        .where(predicate if predicate is not None else everything())
        .groupBy(WEEK)
        .agg(F.count_distinct("user_id").cast("int").alias("distinct_daily_users"))
    )


def weekly_type_counts(activity: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Events per week and activity type: ``year_woy, activity_type, events``.

    The predicate sees ``year_woy`` and ``activity_type``. Counts combine map-side,
    so a hot pair is one row per task in the shuffle.
    """
    rows = activity.select(F.col(STORED_WEEK).alias(WEEK), "activity_type")
    kept = rows.where(predicate if predicate is not None else everything())
    return kept.groupBy(WEEK, "activity_type").agg(F.count(F.lit(1)).alias("events"))


def latest_partition(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Newest key row: all keys sorted descending (NULLs last), top 1.

    Planned as ``TakeOrderedAndProject``: every task keeps its own top row and
    one task merges one row per task, with no shuffle of the data.
    """
    return df.select(*partition_cols).orderBy(*[F.col(c).desc_nulls_last() for c in partition_cols]).limit(1)
