"""Hard-negative mining by coordinate pruning over length buckets.

An anchor's positives are its nearest rows of the same label, by inner product;
a positive's negatives are the nearest rows of other labels whose score lies
within given shares of the positive's. Both are searches for the best scores
under a cap, and both run the same way:

1. rows are grouped by length (geometric buckets) and cut into blocks of bounded
   size; for positives a block holds rows of one label;
2. a first pass over a few blocks of the longest rows gives each anchor a lower
   bound of what it looks for;
3. an anchor goes to the blocks that are long enough to reach its bound, and a
   block's rows only to the groups of anchors that reach it;
4. within a block every coordinate has its sorted list of values (built when it
   is first asked for). The bound over the product of the lengths is a local
   cosine threshold t; a unit row at cosine t or more from the unit anchor has,
   in a coordinate where that is x, a value within
   x*t +- sqrt((1 - x*x) * (1 - t*t)). The ranges of the anchor's focus
   coordinates, its largest ones, are cut out of the lists and intersected;
5. what is left is verified by exact integer products, and the best of each
   block are merged.

A range that holds most of the block rules out too little to be worth an
intersection and is left out; bounds are loosened by 1e-9, so rounding costs no
result. An anchor without a positive bound meets all rows of all blocks.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component take no part; a shorter vector counts as padded with
zeros; a row is never the partner of an anchor of its own id; an id that stands
in several rows is a candidate with each of them, and an anchor with the least
(label, vector); ties go to the smaller id; a positive with a negative score has
no negatives, one with score 0 those of score 0; empty tables give no rows;
other columns of the input, whatever their names, are not read. Products beyond
64 bits wrap around.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

RATIO = 1.15  # of the lengths that a bucket spans
BLOCK = 8192  # rows of a block, about
ANCHORS = 8192  # anchors of a group, about
SEED = 8192  # rows of the first pass, at least
FOCUS = 4  # coordinates whose lists are intersected
WIDE = 0.6  # of a block: a range that holds more is left out
_SLACK = 1e-9
_LONG = 2**63 - 1
_FOUND = "anchor_id long, slot int, vec_id long, score long"
_FOUND_ARROW = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
_BLOCK_KEYS = ["part_of", "bucket", "part", "anchor_group"]


def labelled_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v, norm) of the rows that take part: v = floor(scale * embedding)."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & sound)
    vector = F.transform(x, lambda c: F.floor(c * scale))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("v")).withColumn("norm", length)


def _rows_of(table: pa.Table, name: str, width: int) -> np.ndarray:
    """A list column as a matrix of ``width`` columns, short rows padded with zeros."""
    out = np.zeros((len(table), width), dtype=np.int64)
    at = 0
    for chunk in table.column(name).chunks:
        sizes = np.diff(chunk.offsets.to_numpy())
        here = np.zeros((len(sizes), width), dtype=bool)
        here[np.arange(width)[None, :] < sizes[:, None]] = True
        out[at : at + len(sizes)][here] = chunk.flatten().to_numpy(zero_copy_only=False)
        at += len(sizes)
    return out


def _width(*tables: pa.Table) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max(initial=0)) for t in tables for c in t.column("v").chunks), default=0)


def value_ranges(x: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest coordinate of a unit row at cosine ``t`` or more from a unit anchor with coordinate ``x``."""
    spread = np.sqrt(np.maximum(1 - x * x, 0) * np.maximum(1 - t * t, 0))
    low = np.where(x <= -t, -1.0, x * t - spread)
    high = np.where(x >= t, 1.0, x * t + spread)
    return low - _SLACK, high + _SLACK


class _Block:
    """Rows of a block by falling length, with a sorted list for each coordinate that was asked for."""

    def __init__(self, rows: pa.Table, width: int):
        ids, norms = rows.column("vec_id").to_numpy(), rows.column("norm").to_numpy()
        order = np.lexsort((ids, -norms))
        self.ids, self.norms, self.labels = ids[order], norms[order], rows.column("label").to_numpy()[order]
        self.rows = _rows_of(rows, "v", width)[order]
        self.largest = float(np.abs(self.rows).max(initial=0))
        self.exact = self.rows.astype(np.float64)
        self.unit = self.exact / np.maximum(self.norms, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows in order of coordinate ``f``, and its values in that order."""
        if f not in self.lists:
            by = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = (by, self.unit[by, f])
        return self.lists[f]

    def feasible(self, unit: np.ndarray, t: float, prefix: int) -> np.ndarray:
        """The first ``prefix`` rows, less those that the anchor's focus coordinates rule out at cosine ``t``."""
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        low, high = value_ranges(unit[focus], np.full(len(focus), t))
        ranges = []
        for f, a, b in zip(focus.tolist(), low.tolist(), high.tolist()):
            by, values = self.sorted_list(f)
            i, j = np.searchsorted(values, a), np.searchsorted(values, b, side="right")
            if j - i <= WIDE * len(by):
                ranges.append(by[i:j])
        if not ranges:
            return np.arange(prefix)
        seen = np.zeros(len(self.ids), dtype=np.int8)
        for part in ranges:
            seen[part] += 1
        return np.flatnonzero(seen[:prefix] == len(ranges))

    def products(self, anchor: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact inner products, in doubles where every sum stays below 2**53."""
        if self.largest * float(np.abs(anchor).max(initial=0)) * len(anchor) < 2.0**53:
            return (self.exact[which] @ anchor.astype(np.float64)).astype(np.int64)
        return self.rows[which] @ anchor


def _best_of_block(anchors: pa.Table, rows: pa.Table, k: int, same: bool) -> pa.Table:
    """The ``k`` best rows of one block for each slot of each anchor, within the slot's least and most score."""
    if not len(anchors) or not len(rows):
        return _FOUND_ARROW.empty_table()
    width = _width(anchors, rows)
    block, vectors = _Block(rows, width), _rows_of(anchors, "v", width)
    ids, labels, norms = (anchors.column(c).to_numpy() for c in ("anchor_id", "label", "norm"))
    least, most = anchors.column("least").to_pylist(), anchors.column("most").to_pylist()
    out: list[tuple[int, int, int, int]] = []
    for i in range(len(anchors)):
        bound = min(least[i])
        if bound > 0 and norms[i] > 0:
            shortest = bound / norms[i] * (1 - _SLACK)
            prefix = int(np.searchsorted(-block.norms, -shortest, side="right"))
            if not prefix:
                continue
            which = block.feasible(vectors[i] / norms[i], min(1.0, shortest / block.norms[0]), prefix)
        else:
            which = np.arange(len(block.ids))
        which = which[((block.labels[which] == labels[i]) == same) & (block.ids[which] != ids[i])]
        scores = block.products(vectors[i], which)
        for slot, (a, b) in enumerate(zip(least[i], most[i])):
            ok = (scores >= a) & (scores <= b)
            own, score = which[ok], scores[ok]
            if len(score) > k:
                kth = np.partition(score, len(score) - k)[len(score) - k]
                own, score = own[score >= kth], score[score >= kth]
            for r in np.lexsort((block.ids[own], -score))[:k].tolist():
                out.append((int(ids[i]), slot, int(block.ids[own[r]]), int(score[r])))
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _FOUND_ARROW)], schema=_FOUND_ARROW)


def _met(anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    left, right = anchors.groupBy(*_BLOCK_KEYS), rows.groupBy(*_BLOCK_KEYS)
    return left.cogroup(right).applyInArrow(lambda a, r: _best_of_block(a, r, k, same), _FOUND)


def _ranked(found: DataFrame) -> DataFrame:
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best))


def _search(anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor_id, slot, vec_id, score, rank): the ``k`` best rows for each slot.

    ``anchors`` has anchor_id, label, v, norm and the arrays ``least`` and ``most``,
    the scores that each slot admits. ``same``: rows of the anchor's label, else of others.
    """
    of = F.col("label") if same else F.lit(0).cast("long")
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / math.log(RATIO))).otherwise(F.lit(-1_000_000)).cast("int")
    placed = rows.select("vec_id", "label", "v", "norm", of.alias("part_of"), bucket.alias("bucket"))
    sizes = placed.groupBy("part_of", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"))
    sizes = sizes.withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int"))
    longer = Window.partitionBy("part_of").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.sum(F.col("n") / F.col("parts")).over(longer), F.lit(0.0))
    sizes = materialize(sizes.withColumn("seed", seen < SEED), "negative-buckets")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    blocked = placed.join(sizes, ["part_of", "bucket"]).select(*placed.columns, "seed", part.alias("part"))

    groups = max(1, math.ceil(anchors.count() / ANCHORS))
    asked = anchors.select("*", of.alias("part_of"), F.pmod(F.xxhash64("anchor_id"), F.lit(groups)).cast("int").alias("anchor_group"))

    def searched(asked: DataFrame, sizes: DataFrame, blocked: DataFrame, parts: Column) -> DataFrame:
        """Anchors meet the blocks of ``sizes`` that are long enough, in ``parts`` parts each."""
        bound = F.array_min("least") * F.lit(1 - _SLACK)
        reached = asked.join(sizes, "part_of").where((bound <= 0) | (bound <= F.col("norm") * F.col("longest")))
        met = reached.select(*asked.columns, "bucket", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        # A block's rows go to the groups of anchors that reach it, and to no other.
        pairs = reached.select(*(F.col(c).alias(c) for c in ("part_of", "bucket", "anchor_group"))).distinct()
        return _met(met, blocked.join(pairs, ["part_of", "bucket"]), k, same)

    first = searched(asked, sizes.where("seed"), blocked.where("seed").where("part = 0"), F.lit(1))
    kth = _ranked(first).where(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth"))
    better = F.transform("least", lambda a, i: F.greatest(a, F.coalesce(F.element_at("kth", i), a)))
    bounded = materialize(asked.join(kth, "anchor_id", "left").withColumn("least", better).drop("kth"), "negative-anchors")
    return _ranked(searched(bounded, sizes, blocked, F.col("parts"))).where(F.col("rank") <= k)


def hard_negatives(
    anchors: DataFrame,
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` and ``vectors`` are frames of (vec_id, label, v, norm), see
    :func:`labelled_vectors`. Of each anchor's ``positives`` best rows of its label,
    the ``negatives`` best rows of other labels whose score is from ``low`` to ``high``
    percent of the positive's.
    """
    rows = materialize(vectors.select("vec_id", "label", "v", "norm"), "negative-rows")
    own = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v", "norm")).alias("a"))
    single = materialize(own.select(F.col("vec_id").alias("anchor_id"), "a.label", "a.v", "a.norm"), "negative-asked")
    any_score = {"least": F.array(F.lit(-_LONG - 1)), "most": F.array(F.lit(_LONG))}
    best = _search(single.withColumns(any_score), rows, positives, same=True)
    chosen = materialize(
        best.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "negative-positives",
    )

    def share(percent: int) -> Column:
        return F.col("positive_score").cast("decimal(28,4)") * percent / 100

    limits = chosen.where(F.col("positive_score") >= 0).select(
        "anchor_id",
        F.struct("place", F.ceil(share(low)).cast("long").alias("least"), F.floor(share(high)).cast("long").alias("most")).alias("limit"),
    )
    # At most ``positives`` limits an anchor, in order of their place.
    slots = limits.groupBy("anchor_id").agg(F.sort_array(F.collect_list("limit")).alias("limits"))
    asked = single.join(slots, "anchor_id").select("anchor_id", "label", "v", "norm", F.col("limits.least").alias("least"), F.col("limits.most").alias("most"))
    found = _search(asked, rows, negatives, same=False)
    # Scores fall with the place, so those that admit negatives are the first ones: slot = place - 1.
    return found.withColumn("place", F.col("slot") + 1).join(chosen, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
