"""Source divergence audit: how far the word use of each source is from that of its language.

A term is a maximal run of ASCII letters and characters beyond ASCII, with A-Z
lower-cased. Terms are counted inside the tasks, over slices of bounded size, by
length-bucketed packing: a term of up to 8 bytes is one uint64, one of up to 16
bytes two; these are radix-sorted (16 bits a pass) and counted by runs. Longer
terms go to buckets by length class, each sorted as bytes. What leaves a task is
one row per (lang, source, term) of a slice, which Spark combines before and
after one shuffle.

A language keeps the terms that stand in at least ``least`` of its documents.
Each (lang, source) group, and each language, gives a kept term the share
``p = 1 + floor(10**9 * (count + 1) / (N + V))``, with ``N`` its occurrences of kept
terms and ``V`` the number of kept terms. The divergence of one share from
another is ``floor((p - q)**2 / q)``; all arithmetic is exact.

Pairs of sources are summed over dense blocks of terms x sources, a bounded
number of terms at a time; the result holds every ordered pair of a language's
sources, and so does the work.

Defined results: a null text, lang or source reads as ''; a text without a term
only makes its group occur; a group without terms has the shares of count 0; a
language without kept terms has pairs of value 0 and no terms; repeated rows
are documents each; an empty table gives no row; ties go to the item that is
smaller in UTF-8; other columns of the input, whatever their names, are not
read. A very long text is counted in slices, cut where no term is. Totals
beyond 9 * 10**15 occurrences in a group are outside the exact range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices, materialize

UNIT = 1_000_000_000  # of a share
SLICE = 4 << 20  # bytes of text counted at a time
BLOCK_ROWS = 100_000  # counts of a block of terms, about
CELLS = 1 << 21  # of a dense matrix
_COUNTS = "lang string, source string, term string, n long, docs long"
_COUNTS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, dtype=bool)
_TERM[97:123] = _TERM[128:] = True


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by uint64 ``keys``, the first the most significant: 16 bits a pass, least significant first."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in range(0, 64, 16):
            digit = (key >> np.uint64(shift)).astype(np.uint16)[order]
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit, kind="stable")]  # a radix sort for 16-bit integers
    return order


def _spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every term; text i is data[bounds[i]:bounds[i + 1]]."""
    inside = _TERM[data]
    first = bounds[:-1][bounds[:-1] < len(data)]
    before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[first] = False  # texts stand side by side
    after[first[first > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1 - starts, np.searchsorted(bounds, starts, side="right") - 1


def _packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int) -> np.ndarray:
    """Bytes ``at`` to ``at + 7`` of each term as one uint64 in byte order; 0 stands behind the end, and in no term."""
    key = np.zeros(len(starts), dtype=np.uint64)
    for j in range(at, at + 8):
        byte = data[np.minimum(starts + j, len(data) - 1)]
        key |= np.where(lengths > j, byte, 0).astype(np.uint64) << np.uint64(56 - 8 * (j - at))
    return key


def _buckets(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms by length class: their numbers in sorted order, and where another term begins in that order."""
    for low, high, words in ((1, 8, 1), (9, 16, 2)):
        own = np.flatnonzero((lengths >= low) & (lengths <= high))
        keys = [_packed(data, starts[own], lengths[own], 8 * w) for w in range(words)]
        order = radix_order(keys)
        new = np.ones(len(own), dtype=bool)
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        yield own[order], new
    long = np.flatnonzero(lengths > 16)
    classes = np.ceil(np.log2(lengths[long])).astype(int)
    for c in np.unique(classes).tolist():
        own, width = long[classes == c], 1 << c
        at = starts[own][:, None] + np.arange(width)
        matrix = np.where(np.arange(width) < lengths[own][:, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
        text = matrix.view(f"S{width}").ravel()
        order = np.argsort(text, kind="stable")
        new = np.ones(len(own), dtype=bool)
        new[1:] = text[order][1:] != text[order][:-1]
        yield own[order], new


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))])


def count_terms(texts: list[bytes], group: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """(group, term, occurrences, texts that hold it) of ``texts`` in order of ``group``, a bucket at a time."""
    data = _LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    starts, lengths, text = _spans(data, bounds)
    for order, new_term in _buckets(data, starts, lengths):
        if len(order):
            own_text, own_group = text[order], group[text[order]]
            run, other = new_term.copy(), new_term.copy()
            run[1:] |= own_group[1:] != own_group[:-1]  # the sort is stable: a term's texts stay in order, and so do its groups
            other[1:] |= own_text[1:] != own_text[:-1]
            at = np.flatnonzero(run)
            n = np.diff(np.append(at, len(order)))
            yield own_group[at], _strings(data, starts[order[at]], lengths[order[at]]), n, np.add.reduceat(other.astype(np.int64), at)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces of about SLICE bytes, cut where no term is."""
    data, at = np.frombuffer(text, dtype=np.uint8), 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data):
            gap = np.flatnonzero(~_TERM[_LOWER[data[end : end + SLICE]]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + SLICE, len(data))
        yield text[at:end]
        at = end


def _count_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(lang, source, term, n, docs):
        return pa.RecordBatch.from_arrays([lang, source, term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], schema=_COUNTS_ARROW)

    for batch in byte_slices(batches, "text", SLICE):
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        names = sorted(set(zip(langs, sources)))
        code = {name: i for i, name in enumerate(names)}
        group = np.array([code[x] for x in zip(langs, sources)], dtype=np.int64)
        lang, source = (pa.array([x[k] for x in names], pa.string()) for k in (0, 1))
        none = np.zeros(len(names), dtype=np.int64)
        yield rows(lang, source, pa.nulls(len(names), pa.string()), none, none)  # the group occurs
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        order = np.argsort(group, kind="stable").tolist()
        short = [i for i in order if len(texts[i]) <= SLICE]
        found = list(count_terms([texts[i] for i in short], group[short])) if short else []
        for g, term, n, docs in found:
            yield rows(lang.take(pa.array(g)), source.take(pa.array(g)), term, n, docs)
        for i in order:
            if len(texts[i]) > SLICE:
                seen: set[str] = set()  # a text counts once for a term, in whichever pieces it stands
                for piece in _pieces(texts[i]):
                    for g, term, n, _ in count_terms([piece], group[[i]]):
                        terms = term.to_pylist()
                        docs = np.array([t not in seen for t in terms], dtype=np.int64)
                        seen.update(terms)
                        yield rows(lang.take(pa.array(g)), source.take(pa.array(g)), term, n, docs)


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (counts + 1) / total), exactly: three steps of a long division, three digits each."""
    rest, out = counts + 1, np.zeros(np.broadcast(counts, total).shape, dtype=np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def _share(count: str, total: str) -> Column:
    """:func:`shares` as a column expression."""
    out, rest = "0L", f"({count} + 1)"
    for _ in range(3):
        out, rest = f"({out} * 1000L + ({rest} * 1000L) div ({total}))", f"(({rest} * 1000L) % ({total}))"
    return F.expr(f"1L + {out}")


_SUMS = "lang string, source string, item string, value long"
_SUMS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _pair_sums(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over one block of terms, for each ordered pair of the language's sources."""
    if not len(groups):
        return _SUMS_ARROW.empty_table()
    names = groups.column("source").to_pylist()
    total = groups.column("total").to_numpy()
    number = {name: i for i, name in enumerate(names)}
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    if len(counts):
        row = pa.concat_arrays(counts.column("term").chunks).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        column = np.array([number[s] for s in counts.column("source").to_pylist()], dtype=np.int64)
        n, terms = counts.column("n").to_numpy(), int(row.max()) + 1
        step = max(1, CELLS // len(names))
        for at in range(0, terms, step):
            own = (row >= at) & (row < at + step)
            dense = np.zeros((min(step, terms - at), len(names)), dtype=np.int64)
            dense[row[own] - at, column[own]] = n[own]
            p = shares(dense, total)
            for j in range(len(names)):
                q = p[:, j : j + 1]
                sums[:, j] += ((p - q) ** 2 // q).sum(axis=0)
    i, j = np.nonzero(~np.eye(len(names), dtype=bool))
    lang = groups.column("lang").to_pylist()[0]
    texts = np.array(names, dtype=object)
    return pa.table([pa.array([lang] * len(i), pa.string()), pa.array(texts[i], pa.string()), pa.array(texts[j], pa.string()), pa.array(sums[i, j])], schema=_SUMS_ARROW)


def audit_sources(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for every other source, ``term`` rows for the ``top`` terms used beyond the language's share.

    ``docs`` has text, lang and source. A kept term stands in at least ``least`` documents of its language.
    """
    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = read.mapInArrow(_count_slices, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = materialize(counted, "term-counts")
    terms = counts.where(F.col("term").isNotNull())
    kept = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least)
    used = materialize(terms.drop("docs").join(kept.drop("docs"), ["lang", "term"]), "kept-terms")
    # One row per group and language.
    of_group = used.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.count(F.lit(1)).alias("rows"))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    known = counts.where(F.col("term").isNull()).select("lang", "source").join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    zero = F.lit(0).cast("long")
    blocks = F.greatest(F.lit(1), F.ceil(F.sum(F.coalesce("rows", zero)).over(Window.partitionBy("lang")) / BLOCK_ROWS)).cast("int")
    groups = materialize(
        known.select(
            "lang", "source", blocks.alias("blocks"),
            (F.coalesce("group_total", zero) + F.coalesce("v", zero)).alias("total"),
            (F.coalesce("lang_total", zero) + F.coalesce("v", zero)).alias("lang_total"),
        ),
        "term-groups",
    )

    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    blocked = used.join(groups.select("lang", "source", "blocks"), ["lang", "source"]).select("lang", "source", "term", "n", block.alias("block"))
    asked = groups.select("lang", "source", "total", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    keys = ["lang", "block"]
    sums = blocked.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_pair_sums, _SUMS)
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    p, q = F.col("p"), F.col("q")
    shared = used.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q")
    )
    beyond = shared.where(p > q).select("lang", "source", F.lit("term").alias("part"), "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(best)), beyond.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)]
    return ranked[0].unionByName(ranked[1])
