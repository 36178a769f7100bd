"""Write audit: what each job run did to its tables, as an append-only table.

One append a run, after its last write: rows written, partitions before and
after. A failed run leaves no rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

AUDIT = StructType(
    [
        StructField("table_name", StringType()),
        StructField("operation", StringType()),
        StructField("rows", LongType()),
        StructField("partitions_before", LongType()),
        StructField("partitions_after", LongType()),
        StructField("committed_at", TimestampNTZType()),
    ]
)


def table_history(spark: SparkSession, audit_path: str, table: str) -> DataFrame:
    """Audit rows of ``table``, newest first; none when nothing was recorded yet."""
    try:
        log = spark.read.schema(AUDIT).parquet(audit_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], AUDIT)
    return log.where(F.col("table_name") == table).orderBy(F.col("committed_at").desc())


def record_writes(spark: SparkSession, audit_path: str, writes: Sequence[Mapping[str, Any]]) -> None:
    """Append the writes of one run: mappings of table_name, operation, rows, partitions_before, partitions_after."""
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    rows = [tuple(now if f.name == "committed_at" else w.get(f.name) for f in AUDIT.fields) for w in writes]
    spark.createDataFrame(rows, AUDIT).coalesce(1).write.mode("append").parquet(audit_path)


def delta_is_fresh(spark: SparkSession, path: str) -> bool:
    """For a Delta table: fresh when its history is empty or newest version is 0.

    Needs the delta-spark package; raises ``ValueError`` without it.
    """
    try:
        hist = spark.sql(f"DESCRIBE HISTORY delta.`{path}`")
    except Exception as exc:  # no Delta catalog extension or data source
        raise ValueError("Table history of a Delta table needs the delta-spark package.") from exc
    newest = hist.select(F.max("version")).head()[0]
    return newest is None or int(newest) == 0
