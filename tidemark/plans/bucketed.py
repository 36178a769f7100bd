"""The activity table bucketed by user: distinct users a week without moving rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.weeks import STORED_WEEK


def write_bucketed(
    df: DataFrame, name: str, location: str, buckets: int, *, by: str = "user_id", partition_cols: Sequence[str] = (STORED_WEEK,), fmt: str = "parquet"
) -> None:
    """Write ``df`` as the external table ``name``, partitioned by ``partition_cols`` and bucketed by ``by``; replaces what the name held.

    A bucket is written by one task, so a partition gets one file a bucket. All rows of
    a user lie in the bucket of the same number in every partition: an aggregate
    over (week, user) finds its groups complete in a bucket and needs no exchange; what
    is left to exchange is a row a week and task. A user with a large share of
    all rows makes a large bucket; choose ``buckets`` so that the mean one is well
    below an executor's memory for a sort.
    """
    writer = df.repartition(int(buckets), F.col(by)).write.format(fmt).mode("overwrite").option("path", location).bucketBy(int(buckets), by)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.saveAsTable(name)
