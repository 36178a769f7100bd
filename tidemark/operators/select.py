"""Selecting the partitions to recompute."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import cherry_pick, request_rows
from tidemark.paths import fresh_dir


def keep_requested(df: DataFrame, requests: DataFrame, keys: Sequence[str], prune: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose keys match a row of ``requests`` (NULL keys match any value).

    The same truth table as ``cherry_pick`` for a request held in a DataFrame
    of any size; no request row reaches the driver. The request is written once
    (its distinct key tuples) and read back, so that Spark knows its size.

    ``prune`` names the keys that partition ``df`` (by default the first). Rows that
    have them are met by plain equality, on which Spark prunes partitions
    dynamically: where the request is small enough to be broadcast, only the
    requested folders are read. Rows in which one of them is NULL are a branch of
    their own for each pattern of NULLs, which reads the NULL partitions only.
    Other keys are compared null-safely with each request's NULL patterns.
    """
    keys = list(keys)
    prune = keys[:1] if prune is None else [k for k in keys if k in prune]
    types = {f.name: f.dataType for f in df.schema.fields}
    path = fresh_dir(df.sparkSession, "requests")
    wanted = requests.select(*[F.col(k).cast(types[k]).alias(k) for k in keys]).distinct()
    wanted.write.parquet(path)
    wanted = df.sparkSession.read.schema(wanted.schema).parquet(path)

    def branch(nulls: tuple[str, ...]) -> DataFrame:
        have = [k for k in prune if k not in nulls]
        asked = wanted.select(*[k for k in keys if k not in nulls])
        for k in have:  # a filter on the request is what lets Spark prune by it
            asked = asked.where(F.length(F.col(k).cast("string")) >= 0)
        others = [k for k in keys if k not in prune]
        for k in others:
            asked = asked.select(*[c for c in asked.columns if c != k], F.explode(F.array(F.col(k), F.lit(None).cast(types[k]))).alias(k))
        asked = asked.select(*[F.col(k).alias(f"requested_{k}") for k in asked.columns]).distinct()
        rows = df
        for k in prune:
            rows = rows.where(F.col(k).isNull() if k in nulls else F.col(k).isNotNull())
        if not (have or others):  # every key is NULL: any request will do
            return rows.join(asked.groupBy().agg(F.count(F.lit(1)).alias("asked")).where("asked > 0"), how="left_semi")
        same = [F.col(k) == F.col(f"requested_{k}") for k in have] + [F.col(k).eqNullSafe(F.col(f"requested_{k}")) for k in others]
        return rows.join(asked, reduce(lambda a, b: a & b, same), "left_semi")

    patterns = [c for n in range(len(prune) + 1) for c in combinations(prune, n)]
    return reduce(DataFrame.unionAll, [branch(nulls) for nulls in patterns])


def requests_frame(spark, requests, schema=None) -> DataFrame:
    """The key tuples of a driver-side request as a DataFrame.

    Accepts the same shapes as ``cherry_pick`` (``{"year_woy": [...]}`` or a
    list of key dicts); ``schema`` (DDL or ``StructType``) types the columns.
    """
    names, tuples = request_rows(requests)
    if schema is None:
        schema = ", ".join(f"`{n}` STRING" for n in names)
    return spark.createDataFrame(tuples, schema)


def select_partitions(df: DataFrame, requests) -> DataFrame:
    """Rows of ``df`` matching a cherry-pick request.

    A request held in a DataFrame goes through ``keep_requested``, any other
    becomes a ``cherry_pick`` predicate. Both cast requested values to the
    key's type and give the same rows.
    """
    if isinstance(requests, DataFrame):
        return keep_requested(df, requests, requests.columns)
    return df.where(cherry_pick(requests, schema=df.schema))
