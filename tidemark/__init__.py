"""tidemark: idempotent, partition-scoped batch maintenance on Spark.

Plain functions over DataFrames and Columns:

* ``functions``  - week keys and the partition-selection predicates;
* ``operators``  - weekly distinct users, partition selection, sinks, audit;
* ``sources``    - configured readers (CSV, Parquet, JDBC, Delta if present);
* ``plans``      - table DDL and the jobs that compose the above;
* ``streaming``  - micro-batch replacement of the weeks a stream touches.

The caller owns the SparkSession; nothing here creates or wraps one.
"""

from tidemark.functions.predicates import (
    cherry_pick,
    choose_predicate,
    everything,
    latest,
    strategy,
)
from tidemark.functions.weeks import activity_frame, iso_week_key
from tidemark.operators.aggregate import latest_partition, weekly_distinct_users
from tidemark.operators.select import keep_requested, select_partitions
from tidemark.operators.sinks import append_table, overwrite_all, replace_partitions
from tidemark.plans.jobs import run_overwrite
from tidemark.streaming.replace import start_replace_stream

__all__ = [
    "activity_frame",
    "append_table",
    "cherry_pick",
    "choose_predicate",
    "everything",
    "iso_week_key",
    "keep_requested",
    "latest",
    "latest_partition",
    "overwrite_all",
    "replace_partitions",
    "run_overwrite",
    "select_partitions",
    "start_replace_stream",
    "strategy",
    "weekly_distinct_users",
]
