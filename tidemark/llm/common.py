"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidemark.paths import fresh_dir


TASK_BYTES = 4 << 20  # of a table, as it lies in files, that one task writes


def narrowed(df: DataFrame, at_most: int) -> DataFrame:
    """``df``, of about ``at_most`` bytes or fewer, in few partitions if that is little for the shuffle's width.

    A task that writes a file costs some 60 ms however few its rows are, so a
    small table is not written by one task for every shuffle partition. Spark's
    adaptive coalescing does so too, where the session has it on. No fewer tasks
    than twice the session's cores.
    """
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, at_most // TASK_BYTES + 1)
    return df.coalesce(tasks) if tasks < shuffle_partitions(df.sparkSession) else df


def materialize(df: DataFrame, label: str, at_most: int | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage, and gives Spark the real size of the table, so that it
    broadcasts it only when it is under ``autoBroadcastJoinThreshold``.
    ``at_most``: see :func:`narrowed`; only for what the last shuffle reads, too,
    is about that much or less.
    """
    path = fresh_dir(df.sparkSession, label)
    (df if at_most is None else narrowed(df, at_most)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_bytes(df: DataFrame) -> int:
    """Size Spark's optimizer estimates for ``df`` (file size for a materialized table)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (negative: never broadcast)."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into smaller ones: whole texts of a full batch, as Python strings, take much memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows whose ``column`` holds about ``limit`` bytes; a longer row is alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum([n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()])
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + limit, side="right"))))
            yield batch.slice(at, end - at)
            at = end


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle width: its owner sizes it to the data, and so are our group counts."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
