"""Exact substring dedup with fixed-block anchors.

A *repeat* is a run of at least ``window`` consecutive words of a document that
also stands in a document with a smaller id. Every run of 2b - 1 words holds a
whole block of b words that starts at a multiple of b, so with
b = (window + 1) // 2 it is enough to

1. **index** the non-overlapping b-word blocks of every document and **probe**
   them with every rolling b-word window: a block is *live* if it is indexed and
   occurs in more than one document;
2. **extend** each live block to all full windows around it, and find, for each
   such window, the smallest document it stands in. Windows that overlap join
   to maximal exact repeats, whose words go.

How it runs: documents are dealt into slices by a hash; each slice sends the
distinct keys it holds to buckets, one compact row per (slice, bucket), and each
bucket answers one bit per key it was sent. A key that a third of all documents
share is therefore sent once per slice, and no pair of occurrences is ever made.
The text moves once (the three passes over the slices share one exchange).
Step 1 compares block keys of 30 bits and the bucket number: it only selects,
collisions cost work, not correctness. Step 2 compares 64 bits and the bucket,
which comes from a second hash.

Defined results: a null text has no words; a null ``doc_id`` is neither
reference nor cleaned (its words stay); rows that repeat a doc_id are judged
each by itself, against smaller ids only; texts of under ``window`` words stay;
a very long text is handled whole, in the task of its slice; an empty table gives
no rows; other columns of the input, whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_partitions
from tidemark.llm.hashing import U64, from_planes, hash_words, mix, planes, rolling

SLICE_BYTES = 8_000_000
MESSAGE = "slice int, bucket int, keys binary, docs binary, flags binary"
RESULT = "doc_id long, text string, n_words long, n_removed long, spans array<struct<start: int, end: int>>"
_MESSAGE_ARROW = pa.schema(
    [("slice", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("flags", pa.binary())]
)
_RESULT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.string()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


class _Slice:
    """The words of the documents of a slice, and the distinct block keys it sends."""

    def __init__(self, table: pa.Table, block: int, buckets: int):
        self.ids = table.column("doc_id").to_pylist()
        self.texts = [(t or "").encode() for t in table.column("text").to_pylist()]
        # Rows without an id take no part: they are hashed as empty texts.
        self.words, self.bounds = hash_words([t if i is not None else b"" for i, t in zip(self.ids, self.texts)])
        counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.left = np.repeat(self.bounds[1:], counts) - np.arange(len(self.words))  # words to the end of the text
        self.doc_ids = np.array([0 if i is None else i for i in self.ids], dtype=np.int64)
        self.at = np.flatnonzero(self.left >= block)
        key = rolling(self.words, block)[self.at] if len(self.at) else np.zeros(0, dtype=U64)
        bucket = key % U64(buckets)
        sent = (bucket << U64(30)) | ((mix(key + U64(1)) >> U64(34)))
        self.sent, self.which = np.unique(sent, return_inverse=True)
        self.block = block

    def block_messages(self) -> Iterator[tuple[int, bytes]]:
        """Per bucket: key << 2 | indexed << 1 | in several documents of the slice."""
        doc = self.doc[self.at]
        aligned = (self.at - self.bounds[doc]) % self.block == 0
        indexed = np.zeros(len(self.sent), dtype=bool)
        indexed[self.which[aligned]] = True
        first = np.full(len(self.sent), -1)
        first[self.which] = doc
        several = np.zeros(len(self.sent), dtype=bool)
        several[self.which[first[self.which] != doc]] = True
        entry = ((self.sent & U64((1 << 30) - 1)) << U64(2)) | (indexed.astype(U64) << U64(1)) | several.astype(U64)
        yield from _by_bucket(self.sent >> U64(30), entry.astype(np.uint32))

    def windows(self, live: np.ndarray, window: int, buckets: int):
        """Full windows that hold a live block: their starts, distinct keys (by bucket), and the key of each start."""
        count = np.zeros(len(self.words) + 1, dtype=np.int64)
        count[self.at + 1] = live[self.which]
        count = np.cumsum(count)
        start = np.flatnonzero(self.left >= window)
        start = start[count[start + window - self.block + 1] > count[start]]
        if not len(start):
            empty = np.zeros(0, dtype=np.int64)
            return start, empty.astype(U64), empty.astype(U64), empty
        key, bucket = rolling(self.words, window)[start], rolling(self.words, window, seed=7)[start] % U64(buckets)
        order = np.lexsort((key, bucket))
        k, b = key[order], bucket[order]
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (b[1:] != b[:-1])))
        which = np.empty(len(start), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        return start, b[new], k[new], which

    def smallest(self, start: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, which, self.doc_ids[self.doc[start]])
        return least


def _by_bucket(bucket: np.ndarray, entry: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Entries sorted by bucket, as one message per bucket."""
    if len(bucket):
        cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(bucket[a]), entry[a:b]


def _messages(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(_MESSAGE_ARROW.names, r)) for r in rows], schema=_MESSAGE_ARROW)


def _bits(answers: pa.Table, n: int) -> np.ndarray:
    """The answer bits of a slice, in the order in which it sent the keys."""
    out, at = np.zeros(n, dtype=bool), 0
    rows = [(b, k, f) for b, k, f in zip(*(answers.column(c).to_pylist() for c in ("bucket", "keys", "flags"))) if f is not None]
    for _, size, flags in sorted(rows):
        size = int.from_bytes(size, "little")
        out[at : at + size] = np.unpackbits(np.frombuffer(flags, dtype=np.uint8), count=size)
        at += size
    if at != n:
        raise RuntimeError(f"a slice sent {n} keys and got {at} answers")
    return out


def _answer(slice_: int, bucket: int, bits: np.ndarray) -> tuple:
    return slice_, bucket, len(bits).to_bytes(8, "little"), None, np.packbits(bits).tobytes()


def remove_repeats(docs: DataFrame, window: int = 13, slices: int | None = None, buckets: int | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): kept text, n_words, n_removed, removed word spans.

    Kept words are joined by one space. A slice, and the messages to a bucket,
    are held in one task's memory, so both are cut by the size of the texts: by
    default about ``SLICE_BYTES`` of text a slice, twice that a bucket, and at
    least two of each per shuffle partition.
    """
    spark = docs.sparkSession
    if window < 3:
        raise ValueError("window must be at least 3 words")
    block = (window + 1) // 2
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices = slices or max(2 * shuffle_partitions(spark), size // SLICE_BYTES)
    n_buckets = buckets or max(2 * shuffle_partitions(spark), size // (2 * SLICE_BYTES))
    own = own.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_slices)).cast("int"))
    by_slice = own.groupBy("slice")

    def send_blocks(table: pa.Table) -> pa.Table:
        part = _Slice(table, block, n_buckets)
        slice_ = table.column("slice")[0].as_py()
        return _messages([(slice_, b, planes(e), None, None) for b, e in part.block_messages()])

    def find_live(table: pa.Table) -> pa.Table:
        sent = [from_planes(x, np.uint32) for x in table.column("keys").to_pylist()]
        entry = np.concatenate(sent)
        key, which = np.unique(entry >> 2, return_inverse=True)
        docs_of = np.bincount(which) + np.bincount(which, weights=entry & 1)
        indexed = np.bincount(which, weights=(entry >> 1) & 1)
        live = ((docs_of > 1) & (indexed > 0))[which]
        ends = np.cumsum([len(x) for x in sent])
        bucket = table.column("bucket")[0].as_py()
        return _messages(
            [_answer(s, bucket, live[e - len(x) : e]) for s, x, e in zip(table.column("slice").to_pylist(), sent, ends)]
        )

    def send_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return _messages([])
        part = _Slice(table, block, n_buckets)
        slice_ = table.column("slice")[0].as_py()
        live = _bits(answers, len(part.sent))
        start, bucket, key, which = part.windows(live, window, n_buckets)
        least = part.smallest(start, which, len(key))
        rows = [(slice_, b, planes(key[i]), planes(least[i]), None) for b, i in _by_bucket(bucket, np.arange(len(key)))]
        # The slice needs its live keys again: they travel along as a message to itself.
        return _messages([*rows, (slice_, slice_ % n_buckets, None, None, np.packbits(live).tobytes())])

    def find_first(table: pa.Table) -> pa.Table:
        out, sent = [], []
        for s, b, k, d, f in zip(*(table.column(c).to_pylist() for c in _MESSAGE_ARROW.names)):
            if k is None:
                out.append((s, b, None, f, None))
            else:
                sent.append((s, b, from_planes(k, np.uint64), from_planes(d, np.int64)))
        if sent:
            doc = np.concatenate([x[3] for x in sent])
            key, which = np.unique(np.concatenate([x[2] for x in sent]), return_inverse=True)
            least = np.full(len(key), np.iinfo(np.int64).max)
            np.minimum.at(least, which, doc)
            earlier, at = least[which] < doc, 0
            for s, b, k, _ in sent:
                out.append(_answer(s, b, earlier[at : at + len(k)]))
                at += len(k)
        return _messages(out)

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return _RESULT_ARROW.empty_table()
        part = _Slice(table, block, n_buckets)
        own_row = next(f for f in answers.column("docs").to_pylist() if f is not None)
        live = np.unpackbits(np.frombuffer(own_row, dtype=np.uint8), count=len(part.sent)).astype(bool)
        start, _, key, which = part.windows(live, window, n_buckets)
        earlier = _bits(answers, len(key))
        repeated = earlier[which] | (part.smallest(start, which, len(key))[which] < part.doc_ids[part.doc[start]])
        steps = np.zeros(len(part.words) + 1, dtype=np.int64)
        np.add.at(steps, start[repeated], 1)
        np.add.at(steps, start[repeated] + window, -1)
        removed = np.cumsum(steps[:-1]) > 0
        rows = []
        for i, text in enumerate(part.texts):
            words = text.split()
            gone = removed[part.bounds[i] : part.bounds[i + 1]]
            spans = []
            if gone.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).tolist()
                spans = [{"start": a, "end": b} for a, b in zip(edge[0::2], edge[1::2])]
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                kept = words
            rows.append((part.ids[i], b" ".join(kept).decode(), len(words), len(words) - len(kept), spans))
        columns = list(zip(*rows))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT_ARROW)], schema=_RESULT_ARROW)

    blocks = by_slice.applyInArrow(send_blocks, MESSAGE)
    live = blocks.groupBy("bucket").applyInArrow(find_live, MESSAGE)
    windows = by_slice.cogroup(live.groupBy("slice")).applyInArrow(send_windows, MESSAGE)
    first = windows.groupBy("bucket").applyInArrow(find_first, MESSAGE)
    return by_slice.cogroup(first.groupBy("slice")).applyInArrow(cut, RESULT)
