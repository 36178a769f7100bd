"""Mixing sources to target token weights by entropy balancing.

Every source gets a token target. Document rates r in [0, 2] are chosen that
meet each source's target and, among all such rates, are nearest in relative
entropy to rate 1, the corpus as it is. The solution is exponentially tilted,

    r(d) = min(2, exp(lambda(source) * size(d) / mean size(source))),

so a source whose target is above its size takes more of its long documents, one
below it fewer (a target equal to the size is met as it stands, lambda is 0),

and lambda is the optimum of a convex dual, whose gradient is the token
constraint. It is found by Newton steps, safeguarded by a bracket: each step is
one distributed aggregation for all sources at once, over the counts of
documents per (source, size), which determine it exactly.

Rates are then rounded into whole copies (0, 1 or 2 of each document). Documents
of equal source and size have equal rates, so each such stratum gets a number
of copies, running over sizes from large to small and carrying the rounding
error on; which documents of the stratum get one more follows a hash of their
id and text. Ranking in a stratum goes through salted cells, so a source, or a stratum,
with a third of all rows is spread over all tasks.

What reaches the driver is one row per source; sources are the entries of a
mixing table, so they are few.

Defined results: a null text has size 0, and a document of size 0 is never
taken; a null source is a source, the last; rows that repeat a doc_id are
documents each; if all sizes are 0, so are all targets; an empty table gives no
rows. Which of several rows that are equal in id, source and size gets the
extra copy is left open; they are alike.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, shuffle_partitions, table_bytes

MOST = 2  # copies of a document, and of a source's tokens
_TOLERANCE = 1e-9  # of a target, at which Newton's iteration ends
_STEPS = 60


def token_targets(sizes: dict, weights: tuple[float, ...], share: float) -> dict:
    """Token target per source: ``share`` of all tokens by weight, none above MOST times its own size.

    Sources take the weights in turn, in code point order, null last; what a
    source cannot take is shared among the others by weight.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))  # Python compares code points
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), list(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > MOST * sizes[s]]
        if not full:
            target.update((s, unit * weight[s]) for s in open_)
            break
        for s in full:
            target[s] = float(MOST * sizes[s])
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    return target


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, source, size): words are runs of characters other than ASCII white space."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    text_hash = F.xxhash64(F.col("text").cast("string")).alias("text_hash")
    return docs.select("doc_id", text_hash, F.col("source").cast("string").alias("source"), words.cast("long").alias("size"))


def tilted(tilt: Column, size: Column, mean: Column) -> Column:
    return F.least(F.lit(float(MOST)), F.exp(F.least(tilt * size / mean, F.lit(700.0))))


def exact(value: Column) -> Column:
    """Sum of doubles as decimals: it does not depend on the order of the rows, so neither do tilts and rates."""
    return F.sum(value.cast("decimal(38,12)"))


def solve_tilts(strata: DataFrame, sources: list[dict]) -> dict:
    """Source to tilt, from (source, size, n) and the sources' ``target``, ``size`` and ``mean``.

    One aggregation per Newton step serves all sources that have not converged.
    A source at its limit takes everything: its tilt is infinite. One without a
    target takes nothing: minus infinity.
    """
    spark = strata.sparkSession
    start = {s["source"]: 0.0 if s["target"] > 0 else -math.inf for s in sources}
    tilt = {s["source"]: start[s["source"]] if s["target"] < MOST * s["size"] else math.inf for s in sources}
    low, high = dict.fromkeys(tilt, -math.inf), dict.fromkeys(tilt, math.inf)
    by = {s["source"]: s for s in sources}
    todo = [s for s in tilt if math.isfinite(tilt[s])]
    for _ in range(_STEPS):
        if not todo:
            break
        rows = [(s, tilt[s], by[s]["mean"]) for s in todo]
        state = spark.createDataFrame(rows, "source string, tilt double, mean double")
        r = tilted(F.col("tilt"), F.col("size"), F.col("mean"))
        x, tokens = F.col("size") / F.col("mean"), F.col("n") * r * F.col("size")
        sums = (
            strata.withColumnRenamed("source", "of")
            .join(F.broadcast(state), F.col("of").eqNullSafe(F.col("source")))
            .groupBy("source")
            .agg(exact(tokens).alias("tokens"), exact(F.when(r < MOST, tokens * x).otherwise(0.0)).alias("slope"))
        )
        rest = []
        for row in sums.collect():
            s, gap, slope = row.source, float(row.tokens) - by[row.source]["target"], float(row.slope)
            if abs(gap) <= _TOLERANCE * by[s]["target"]:
                continue
            if gap > 0:
                high[s] = tilt[s]
            else:
                low[s] = tilt[s]
            step = tilt[s] - gap / slope if slope > 0 else math.nan
            if not low[s] < step < high[s]:  # outside the bracket, or flat: bisect, or widen
                if math.isfinite(low[s]) and math.isfinite(high[s]):
                    step = (low[s] + high[s]) / 2
                else:
                    step = tilt[s] + (1.0 if gap < 0 else -1.0) * max(1.0, abs(tilt[s]))
            if step != tilt[s]:
                tilt[s] = step
                rest.append(s)
        todo = rest
    if todo:
        raise RuntimeError(f"The tilts of {len(todo)} sources did not converge in {_STEPS} steps.")
    return tilt


def round_strata(frame: pd.DataFrame) -> pd.DataFrame:
    """Copies of each stratum of a source (size, n, rate), from large sizes to small, carrying the error on."""
    frame = frame.sort_values("size", ascending=False, kind="stable")
    copies, ahead = np.zeros(len(frame), dtype=np.int64), 0.0
    for i, (size, n, rate) in enumerate(zip(frame["size"].tolist(), frame["n"].tolist(), frame["rate"].tolist())):
        if size > 0:
            copies[i] = min(MOST * n, max(0, math.floor(n * rate - ahead / size + 0.5)))
            ahead += (copies[i] - n * rate) * size
    return frame.assign(copies=copies)[["source", "size", "n", "copies"]]


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, text): doc_id, source, size, source_size, target, rate, copies, text_hash.

    ``text_hash`` is xxhash64 of the text, which tells rows that repeat a doc_id apart.
    """
    spark = docs.sparkSession
    salts = shuffle_partitions(spark)
    # By id and text: rows of one id (or none) spread over the cells too.
    salt = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(salts)).cast("int")
    sized = materialize(document_sizes(docs).withColumn("salt", salt), "document-sizes")
    cells = materialize(sized.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n")), "size-cells", table_bytes(sized))
    strata = materialize(cells.groupBy("source", "size").agg(F.sum("n").alias("n")), "size-strata", table_bytes(cells))
    totals = strata.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")).collect()
    target = token_targets({r.source: r["size"] for r in totals}, weights, share)
    sources = [
        {
            "source": r.source,
            "size": r["size"],
            "target": target[r.source],
            "mean": r["size"] / r.n or 1.0,
        }
        for r in totals
    ]
    tilts = solve_tilts(strata, sources)
    solved = spark.createDataFrame(
        [(s["source"], s["size"], s["target"], s["mean"], tilts[s["source"]]) for s in sources],
        "of string, source_size long, target double, mean double, tilt double",
    )
    same = F.col("source").eqNullSafe(F.col("of"))
    free = tilted(F.col("tilt"), F.col("size"), F.col("mean"))
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("tilt") == float("inf"), float(MOST)).otherwise(free).alias("rate")
    rated = strata.join(F.broadcast(solved), same).select("source", "size", "n", rate)
    # A source's strata are at most as many as it has different sizes.
    copies = materialize(
        rated.groupBy("source").applyInPandas(round_strata, "source string, size long, n long, copies long"), "stratum-copies", 2 * table_bytes(strata)
    ).select(F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("n").alias("stratum"), "copies")
    # Documents of a stratum before each of its cells; then the rank in the cell gives the rank in the stratum.
    before = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = offsets.join(copies, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")))
    cell_keys = [F.col(c).alias(f"o_{c}") for c in ("source", "size", "salt")]
    offsets = materialize(offsets.select(*cell_keys, "offset", "stratum", "copies"), "stratum-cells", 2 * table_bytes(cells))
    cell = Window.partitionBy("source", "size", "salt").orderBy("doc_id", "text_hash")
    ranked = sized.where("size > 0").withColumn("rank", F.row_number().over(cell))
    same_cell = F.col("source").eqNullSafe(F.col("o_source")) & F.expr("size = o_size and salt = o_salt")
    extra = F.col("offset") + F.col("rank") <= F.col("copies") % F.col("stratum")
    each = (F.floor(F.col("copies") / F.col("stratum")) + extra.cast("int")).cast("int").alias("copies")
    taken = ranked.join(offsets, same_cell).select("doc_id", "text_hash", "source", "size", each)
    empty = sized.where("size = 0").select("doc_id", "text_hash", "source", "size", F.lit(0).alias("copies"))
    counted = taken.unionByName(empty)  # empty documents are never taken, so none of them is ranked
    return counted.join(F.broadcast(solved), same).select("doc_id", "source", "size", "source_size", "target", rate, "copies", "text_hash")
