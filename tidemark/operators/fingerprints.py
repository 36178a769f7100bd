"""Content fingerprints of partitions: which ones a load has to rewrite.

A fingerprint is the number of rows, the exclusive or of one row hash and the sum
of another: it does not depend on the order of rows or files, and one aggregate
that combines map-side computes it. Fingerprints of what was written are kept in
an append-only log; the last entry of a partition counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DIGEST = ("n_rows", "hash_xor", "hash_sum")
_AT = "committed_at"


def fingerprints(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, n_rows, hash_xor, hash_sum: one row per partition. A null differs from every value, and from a null elsewhere."""
    cells = [c for name in sorted(df.columns) for c in (F.col(name).isNull(), F.col(name))]
    first, second = (F.xxhash64(F.lit(seed), *cells) for seed in (1, 2))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor(first).alias("hash_xor"), F.sum(second.cast("decimal(20,0)")).cast("string").alias("hash_sum")
    )


def last_fingerprints(spark: SparkSession, log: str, keys: Sequence[str]) -> DataFrame | None:
    """The newest logged fingerprint of each partition; None when nothing was logged yet."""
    try:
        rows = spark.read.parquet(log)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*_DIGEST), _AT).alias("d"))
    return newest.select(*keys, *(f"d.{c}" for c in _DIGEST))


def changed_partitions(current: DataFrame, logged: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose partition is not logged with the same fingerprint."""
    if logged is None:
        return current
    known = logged.select(*(F.col(c).alias(f"known_{c}") for c in (*keys, *_DIGEST)))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in (*keys, *_DIGEST)])
    return current.join(known, same, "left_anti")


def log_fingerprints(rows: DataFrame, log: str) -> None:
    """Append fingerprints (one row per partition written), after the partitions themselves."""
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    rows.withColumn(_AT, F.lit(now)).coalesce(1).write.mode("append").parquet(log)
