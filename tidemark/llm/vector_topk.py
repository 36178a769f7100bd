"""Exact top-k inner products over norm buckets.

Candidates are grouped by length (geometric buckets) and cut into blocks of
bounded size. Queries meet blocks, in blocks of their own:

1. a first pass over the longest vectors gives each query a lower bound of its
   k-th best score;
2. with it, a query skips every bucket too short to reach the bound. In the
   blocks that are left, the local cosine threshold (bound over query length
   times block length) chooses the pruning: a high one allows *coordinate*
   pruning, which keeps the candidates whose largest query coordinates lie in
   the feasible range; a low one only *length* pruning, a prefix of the block
   in order of length;
3. what is left is verified by exact products, and the k best of each block
   merge to the k best of the query.

Bounds are loosened by a relative 1e-9, so rounding never costs a result.

Defined results: rows with a null id, a null vector, or null or non-finite
components take no part; a shorter vector counts as padded with zeros; rows
that repeat a vec_id are candidates each (never of the query of that id), and
the smallest of their vectors is the query; ties go to the smaller vec_id;
products beyond 64 bits wrap around; empty tables give no rows; other columns
of the input, whatever their names, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

RATIO = 1.1  # of the lengths that a bucket spans
BLOCK = 8192  # candidates of a block, about
QUERIES = 1024  # queries of a block, about
SEED = 4096  # candidates of the first pass, at least
COSINE = 0.7  # local threshold from which coordinate pruning pays
FOCUS = 3  # coordinates that it looks at
_SLACK = 1e-9
_OUT = "query_id long, vec_id long, score long"
_OUT_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integer_vectors(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v, norm) of the rows that take part: v = floor(scale * embedding)."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    v = F.transform(x, lambda c: F.floor(c * scale))
    kept = rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & sound).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return kept.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


def _pad(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact q @ c.T: in doubles where every sum stays below 2**53."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), dtype=np.int64)
    if float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < 2.0**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def feasible(unit: np.ndarray, order: list, c: np.ndarray, cosine: float) -> np.ndarray:
    """Candidates (rows of the unit matrix ``c``) that may reach ``cosine`` with the unit vector ``unit``.

    ``order`` caches, per coordinate, the candidates in its order.
    """
    angle = math.acos(min(1.0, max(-1.0, cosine))) + 1e-6  # beyond the rounding of acos near 1
    found = None
    for f in np.argsort(-np.abs(unit))[:FOCUS].tolist():
        if order[f] is None:
            by = np.argsort(c[:, f], kind="stable")
            order[f] = (by, c[by, f])
        by, values = order[f]
        # Unit vectors at an angle of at most this differ in their angle to the axis by no more.
        own = math.acos(min(1.0, max(-1.0, unit[f])))
        low, high = math.cos(min(math.pi, own + angle)) - _SLACK, math.cos(max(0.0, own - angle)) + _SLACK
        part = by[np.searchsorted(values, low) : np.searchsorted(values, high, side="right")]
        found = part if found is None else np.intersect1d(found, part)
    return np.sort(found) if found is not None else np.arange(len(c))


def _best_of_block(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    if not len(queries) or not len(candidates):
        return _OUT_ARROW.empty_table()
    q, c = _matrix(queries.column("v")), _matrix(candidates.column("v"))
    width = max(q.shape[1], c.shape[1])
    q, c = _pad(q, width), _pad(c, width)
    q_id, c_id = queries.column("query_id").to_numpy(), candidates.column("vec_id").to_numpy()
    q_norm, c_norm = (t.column("norm").to_numpy() for t in (queries, candidates))
    bound = queries.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)  # NaN: none
    bound = np.where(np.isnan(bound), -np.inf, bound)
    by_length = np.lexsort((c_id, -c_norm))
    c, c_id, c_norm = c[by_length], c_id[by_length], c_norm[by_length]
    with np.errstate(divide="ignore", invalid="ignore"):
        shortest = np.where(bound > 0, bound / q_norm, -np.inf) * (1 - _SLACK)
        local = shortest / c_norm[0]
    prefix = np.searchsorted(-c_norm, -shortest, side="right")  # candidates long enough for the bound
    rows = []

    def keep(i: int, which: np.ndarray, scores: np.ndarray) -> None:
        ok = (scores >= bound[i]) & (c_id[which] != q_id[i])
        which, scores = which[ok], scores[ok]
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            which, scores = which[scores >= least], scores[scores >= least]
        top = np.lexsort((c_id[which], -scores))[:k]
        rows.extend((int(q_id[i]), int(c_id[which[t]]), int(scores[t])) for t in top)

    sharp = np.flatnonzero((local >= COSINE) & (prefix > 0))
    order: list = [None] * width
    unit_c = c / np.maximum(c_norm, 1e-300)[:, None] if len(sharp) else None
    for i in sharp.tolist():
        which = feasible(q[i] / q_norm[i], order, unit_c, min(1.0, local[i]))
        which = which[which < prefix[i]]
        keep(i, which, _products(q[i : i + 1], c[which])[0])
    flat = np.flatnonzero(~(local >= COSINE) & (prefix > 0))
    for at in range(0, len(flat), 256):
        part = flat[at : at + 256]
        scores = _products(q[part], c[: prefix[part].max()])
        for row, i in enumerate(part.tolist()):
            keep(i, np.arange(prefix[i]), scores[row, : prefix[i]])
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=_OUT_ARROW)


def _met(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The k best of each block for each query; both sides have ``q_block`` and ``block``."""
    keys = ["q_block", "block"]
    return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(lambda q, c: _best_of_block(q, c, k), _OUT)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) from two frames of (vec_id, v, norm), see :func:`integer_vectors`."""
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / math.log(RATIO))).otherwise(F.lit(-1)).cast("int")
    bucketed = vectors.select("vec_id", "v", "norm", bucket.alias("bucket"))
    # One row per bucket: a double has at most log(1.8e308) / log(RATIO) of them, whatever the data.
    sizes = sorted(bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).collect(), reverse=True)
    single = queries.groupBy("vec_id").agg(F.min(F.struct("v", "norm")).alias("q")).select(F.col("vec_id").alias("query_id"), "q.v", "q.norm")
    empty = F.lit(None).cast("double").alias("bound")
    if not sizes:
        nothing = (F.lit(1).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0).cast("long").alias("score"))
        return single.limit(0).select("query_id", *nothing)
    n_queries = max(1, math.ceil(single.count() / QUERIES))
    table, blocks, seeds, seen = [], 0, 0, 0
    for size in sizes:  # the longest vectors are in the first blocks
        parts = math.ceil(size.n / BLOCK)
        table.append((size.bucket, blocks, parts, size.longest))
        for _ in range(parts):
            seeds, seen = (seeds, seen) if seen >= SEED else (seeds + 1, seen + size.n // parts)
        blocks += parts
    spark = vectors.sparkSession
    plan = spark.createDataFrame(table, "bucket int, first int, parts int, longest double")
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int")
    candidates = bucketed.join(F.broadcast(plan), "bucket").select("vec_id", "v", "norm", block.alias("block"))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("q_block")
    asked = single.withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(n_queries)).cast("int"))
    seeded = asked.select("*", empty, F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))).alias("block"))
    first = _met(seeded, candidates.where(F.col("block") < seeds).select("*", every), k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    bounds = kth.select("query_id", F.col("score").cast("double").alias("bound"))
    bounded = materialize(asked.join(bounds, "query_id", "left"), "topk-bounds")
    spans = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(("first", "parts", "longest"), t[1:]))) for t in table))
    reachable = bounded.select("*", F.explode(spans).alias("span")).where(
        F.col("bound").isNull() | (F.col("bound") <= 0) | (F.col("bound") * (1 - _SLACK) <= F.col("norm") * F.col("span.longest"))
    )
    reachable = reachable.withColumn("block", F.explode(F.sequence("span.first", F.col("span.first") + F.col("span.parts") - 1))).drop("span")
    # A candidate goes to the blocks of queries that reach its block, and to no other.
    pairs = reachable.select(F.col("q_block").alias("q_block"), F.col("block").alias("block")).distinct()
    found = _met(reachable, candidates.join(pairs, "block"), k)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
