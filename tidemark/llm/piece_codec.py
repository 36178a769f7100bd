"""SentencePiece BPE: encoding by vectorised merge rounds, and decoding.

A text becomes words: a run of spaces with the characters up to the next space.
No piece of the vocabulary may hold a space behind another character (checked
when the model is read; such a model takes the whole text as one word), so no
merge crosses a word. The distinct words of a slice of texts lie in one flat
array of symbols, with the rank of every neighbouring pair. A round takes each
word's best rank (segmented minimum), merges all its pairs of that rank that do
not overlap, from the left, and compacts the arrays; a word that has no pair
left is done. The library merges one pair at a time, so a round stops in a word
behind the first merge that makes a pair as good or better: what follows
is left to the next round, and both give the same pieces. Words that are still
not done after ``ROUNDS`` rounds (long runs of spaces, say, merge one pair a
round) end in a queue of their pairs in the same order.

Characters outside the vocabulary become their UTF-8 bytes. Decoding joins the
pieces, a space for each U+2581, without the space that encoding put in front;
bytes that are no UTF-8 become U+FFFD each.

Models: BPE with byte fallback and the identity normaliser, without user-defined
or unused pieces; anything else raises ``ValueError``. The model file is read
once, on the driver; its bytes (0.5 MB for 32,000 pieces) go to the tasks.

Defined results: a null or empty text has only the end id, and decodes to '';
rows that repeat are encoded each; an empty table gives no rows; U+2581 in a
text is read as a space, as the library does; other columns of the input,
whatever their names, are not read. Texts of any length are encoded whole; the
table of distinct words that a task keeps is emptied when it is full, which
changes no result.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices, slices

SPACE = "▁"
ROUNDS = 64
SLICE = 2 << 20  # bytes of text encoded at a time
WORDS = 300_000  # distinct words a task keeps, about
_NONE = np.int64(1 << 40)  # the rank of a pair that is no piece
_CHARACTERS = 0x110000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol buffer message: integers, and bytes for everything else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


class PieceModel:
    """Vocabulary and merge table of a model file's bytes."""

    def __init__(self, data: bytes):
        # Fixed field numbers and values of the model file's format.
        self.pieces, scores, kinds = [], [], []
        trainer, normalizer = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(np.frombuffer(piece.get(2, b"\0\0\0\0"), dtype="<f4")[0])
                kinds.append(piece.get(3, 1))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        self.kinds = np.array(kinds)
        normal, control, byte = (np.flatnonzero(self.kinds == k) for k in (1, 3, 6))
        wrong = [
            text
            for text, bad in (
                ("it is no BPE model", trainer.get(3, 1) != 2),
                ("it has no byte fallback", len(byte) != 256),
                ("it has user-defined or unused pieces", bool(np.isin(self.kinds, (4, 5)).any())),
                ("it takes white space as a suffix", bool(trainer.get(24, 0))),
                ("it normalises texts", bool(normalizer.get(2)) or bool(normalizer.get(4, 1)) or not normalizer.get(5, 1)),
            )
            if bad
        ]
        if wrong:
            raise ValueError("This model cannot be used: " + ", ".join(wrong) + ".")
        self.prefix = bool(normalizer.get(3, 1))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.control = set(control.tolist())
        self.end = trainer.get(42, 2)
        self.byte_id = {int(self.pieces[i][1:-1], 16): i for i in byte.tolist()}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        #: The text of a piece inside a text.
        self.surface = [self.unknown_text if kind == 2 else text.replace(SPACE, " ") for text, kind in zip(self.pieces, kinds)]
        raw = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.control else text.encode() for i, text in enumerate(self.surface)]
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_size = np.array([len(x) for x in raw], dtype=np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.is_byte, self.is_control = self.kinds == 6, self.kinds == 3
        self.spaced = np.array([text[:1] == SPACE for text in self.pieces])

        # Symbols: normal pieces by id, other single characters behind all ids.
        number = {self.pieces[i]: i for i in normal.tolist()}
        best = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.tolist()}, reverse=True))}
        self.single = np.arange(_CHARACTERS, dtype=np.int64) + len(self.pieces)
        for text, i in number.items():
            if len(text) == 1:
                self.single[ord(text)] = i
        self.width = len(self.pieces) + _CHARACTERS

        def symbol(text: str) -> int | None:
            return int(self.single[ord(text)]) if len(text) == 1 else number.get(text)

        merges = []
        for text, i in number.items():
            for cut in range(1, len(text)):
                left, right = symbol(text[:cut]), symbol(text[cut:])
                if left is not None and right is not None:
                    merges.append((left * self.width + right, best[scores[i]], i))
        merges.sort()
        self.pair, self.rank, self.into = (np.array([m[k] for m in merges], dtype=np.int64) for k in range(3))
        self.table = {m[0]: m[1:] for m in merges}
        # Where a pair stands in ``pair``, by its hash: most lookups are of pairs that are no piece, and end at an empty slot.
        self.slots = max(8, 4 + len(merges).bit_length())
        slot = self._slot(self.pair)
        self.at = np.full(1 << self.slots, -1, dtype=np.int32)
        self.at[slot] = np.arange(len(self.pair), dtype=np.int32)
        self.crowded = np.bincount(slot, minlength=1 << self.slots) > 1  # slots of several pairs, of which ``at`` holds one
        self.pair_or_none = np.append(self.pair, -1)
        self.rank_or_none, self.into_or_none = np.append(self.rank, _NONE), np.append(self.into, 0)
        spaced = any(SPACE in text.lstrip(SPACE) for text in number)
        self.word = re.compile(".+" if spaced else f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.DOTALL)

    def words(self, text: str) -> list[str]:
        """The words of a text, which are encoded each on its own."""
        if not text:
            return []
        return self.word.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE))

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; ``_NONE`` where the vocabulary has no such piece."""
        key = left * self.width + right
        slot = self._slot(key)
        at = self.at[slot]
        at[self.pair_or_none[at] != key] = -1
        other = np.flatnonzero((at < 0) & self.crowded[slot])
        if len(other):
            found = np.minimum(np.searchsorted(self.pair, key[other]), len(self.pair) - 1)
            at[other] = np.where(self.pair[found] == key[other], found, -1)
        return self.rank_or_none[at], self.into_or_none[at]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.slots)).astype(np.int64)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after merging, and their bounds: those of word i are symbols[bounds[i]:bounds[i + 1]]."""
        if not words:
            return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        symbols, word = self.single[points], np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_word = [], []
        rank, into = self._pairs(symbols, word)
        for _ in range(ROUNDS):
            if not len(symbols):
                break
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, starts)
            length = np.diff(np.append(starts, len(symbols)))
            if (least == _NONE).any():  # compaction: words without a pair are done
                over = np.repeat(least == _NONE, length)
                done_symbols.append(symbols[over])
                done_word.append(word[over])
                symbols, word, rank, into = (x[~over] for x in (symbols, word, rank, into))
                length, least = length[least != _NONE], least[least != _NONE]
                if not len(symbols):
                    break
                starts = np.cumsum(length) - length
            at = self._chosen(symbols, word, rank, into, np.repeat(least, length))
            symbols[at] = into[at]
            stays = np.ones(len(symbols), dtype=bool)
            stays[at + 1] = False
            place = np.cumsum(stays) - 1
            symbols, word, rank, into = (x[stays] for x in (symbols, word, rank, into))
            changed = np.zeros(len(symbols) + 1, dtype=bool)
            changed[place[at]] = changed[place[at] - 1] = True  # place 0 has no pair before it: -1 is the spare cell
            changed = np.flatnonzero(changed[:-1])
            rank[changed], into[changed] = self._pairs(symbols, word, changed)
        if len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(symbols)]):
                rest = self._queued(symbols[a:b].tolist())
                done_symbols.append(np.array(rest, dtype=np.int64))
                done_word.append(np.full(len(rest), word[a]))
        symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, dtype=np.int64)
        word = np.concatenate(done_word) if done_word else np.zeros(0, dtype=np.int64)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def _pairs(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of the pairs that begin at ``at`` (everywhere by default)."""
        at = np.arange(len(symbols)) if at is None else at
        right = np.minimum(at + 1, len(symbols) - 1)
        rank, into = self._ranked(symbols[at], symbols[right])
        apart = (right == at) | (word[right] != word[at])
        rank[apart] = _NONE
        return rank, into

    def _chosen(self, symbols, word, rank, into, least) -> np.ndarray:
        """Where this round merges: pairs of the word's least rank that do not overlap, up to the first that makes a pair as good or better."""
        flagged = np.flatnonzero(rank == least)
        run = np.flatnonzero(np.r_[True, np.diff(flagged) != 1])
        offset = np.arange(len(flagged)) - np.repeat(run, np.diff(np.append(run, len(flagged))))
        at = flagged[offset % 2 == 0]
        made = into[at]
        # The neighbours in the library's order: to the left what is merged by now, to the right what is not yet.
        before = np.where(at > 0, symbols[at - 1], 0)
        joined = np.r_[False, at[1:] == at[:-1] + 2]
        before[joined] = made[np.flatnonzero(joined) - 1]
        has_before = (at > 0) & (word[at - 1] == word[at])
        behind = np.minimum(at + 2, len(symbols) - 1)
        has_behind = (at + 2 < len(symbols)) & (word[behind] == word[at])
        left = np.where(has_before, self._ranked(before, made)[0], _NONE)
        right = np.where(has_behind, self._ranked(made, symbols[behind])[0], _NONE)
        unsafe = (np.minimum(left, right) <= rank[at]).astype(np.int64)
        earlier = np.cumsum(unsafe) - unsafe
        first = np.flatnonzero(np.r_[True, word[at][1:] != word[at][:-1]])
        base = np.repeat(earlier[first], np.diff(np.append(first, len(at))))
        return at[earlier == base]

    def _queued(self, symbols: list[int]) -> list[int]:
        """The rest of one word by a queue of its pairs: best rank first, then the leftmost."""
        n, table, width = len(symbols), self.table, self.width
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n and (found := table.get(symbols[a] * width + symbols[b])):
                heapq.heappush(queue, (found[0], a, b, symbols[a], symbols[b]))

        for a in range(n - 1):
            offer(a, a + 1)
        while queue:
            _, a, b, left, right = heapq.heappop(queue)
            if symbols[a] != left or symbols[b] != right or after[a] != b:
                continue
            symbols[a], symbols[b] = table[left * width + right][1], -1
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in symbols if s >= 0]

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        symbols, bounds = self.merged(words)
        other = np.flatnonzero(symbols >= len(self.pieces))
        if not len(other):
            return symbols, np.diff(bounds)
        spelled = [[self.byte_id[b] for b in chr(s).encode("utf-8", "surrogatepass")] for s in (symbols[other] - len(self.pieces)).tolist()]
        sizes = np.ones(len(symbols), dtype=np.int64)
        sizes[other] = [len(x) for x in spelled]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.repeat(symbols, sizes)
        ids[np.repeat(sizes > 1, sizes) | (ids >= len(self.pieces))] = [i for x in spelled for i in x]
        return ids, np.diff(ends[bounds])

    def encode(self, text: str) -> list[int]:
        """The ids of a text, without an end id."""
        return self.ids(self.words(text))[0].tolist() if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; an id outside the vocabulary raises ``IndexError``."""
        parts: list[str] = []
        run = bytearray()  # ids of bytes next to each other are one run of UTF-8
        at_start = self.prefix
        for i in ids:
            if not 0 <= i < len(self.pieces):
                raise IndexError(f"id {i} is not in the vocabulary")
            if (byte := self.byte_of.get(i)) is not None:
                run.append(byte)
                at_start = False
                continue
            if run:
                parts.append(_utf8(bytes(run)))
                run.clear()
            if i in self.control:
                continue
            text = self.surface[i]
            parts.append(text[1:] if at_start and self.pieces[i][0] == SPACE else text)
            at_start = False
        return "".join(parts) + _utf8(bytes(run))

    def decode_lists(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of many lists at once: list i is ids[bounds[i]:bounds[i + 1]]."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.pieces)):
            raise IndexError("an id is not in the vocabulary")
        size, start = self.raw_size[ids], self.raw_start[ids]
        control, starts = self.is_control[ids], bounds[:-1]
        if self.prefix and len(ids):  # the space in front of a text
            first = np.flatnonzero(~control)
            first = first[np.minimum(np.searchsorted(first, starts), len(first) - 1)] if len(first) else starts[:0]
            own = first[(first >= starts[: len(first)]) & (first < bounds[1:][: len(first)])]
            own = own[self.spaced[ids[own]]]
            size[own] -= 1
            start[own] += 1
        ends = np.concatenate(([0], np.cumsum(size)))
        data = self.raw[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
        at = ends[bounds]
        # Lists with bytes: they are UTF-8 as a whole, or go through decode() one by one.
        inner = control.copy()
        inner[bounds[1:][bounds[1:] > starts] - 1] = False
        texts = {}
        with_bytes = np.searchsorted(bounds, np.flatnonzero(self.is_byte[ids]), side="right") - 1
        split = set((np.searchsorted(bounds, np.flatnonzero(inner), side="right") - 1).tolist())
        for i in np.unique(with_bytes).tolist():
            try:
                if i in split:
                    raise ValueError
                data[at[i] : at[i + 1]].tobytes().decode()
            except ValueError:
                texts[i] = self.decode(ids[bounds[i] : bounds[i + 1]].tolist())
        if texts:
            return pa.array([texts[i] if i in texts else data[a:b].tobytes().decode() for i, (a, b) in enumerate(zip(at[:-1], at[1:]))], pa.string())
        return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def _utf8(data: bytes) -> str:
    """``data`` decoded, with one U+FFFD for each byte that is not part of a character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[at : at + e.start].decode() + "\ufffd")
            at += e.start + 1
    return "".join(out)


def _numbers() -> defaultdict[str, int]:
    """Word -> its number, in the order in which they are looked up first; 0 is the end of a text."""
    numbers = defaultdict(count(1).__next__)
    numbers[""] = 0
    return numbers


@lru_cache(maxsize=2)
def piece_model(data: bytes) -> PieceModel:
    """The model of a file's bytes, built once in a process."""
    return PieceModel(data)


def read_model(spark: SparkSession, path: str) -> bytes:
    """The bytes of a model file, on any storage that the driver or Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


_IDS_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_TEXT_ARROW = pa.schema([*_IDS_ARROW, ("decoded", pa.string())])


def encode_documents(docs: DataFrame, model: bytes, end: bool = True) -> DataFrame:
    """(doc_id, ids) of ``docs``: the ids of the whole text, the end id last (not with ``end=False``)."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_model(model)
        tail = [codec.end] if end else []
        # The ids of the words by their numbers; those of the end of a text stand first.
        known, ids, sizes = _numbers(), np.array(tail, dtype=np.int32), np.array([len(tail)])
        for batch in byte_slices(batches, "text", SLICE):
            texts = [codec.words(t) for t in batch.column("text").to_pylist()]
            for words in texts:
                words.append("")
            word = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=sum(map(len, texts)))
            if len(known) > len(sizes):
                more = codec.ids(list(islice(known, len(sizes), None)))
                ids, sizes = np.concatenate((ids, more[0].astype(np.int32))), np.concatenate((sizes, more[1]))
            ends = np.cumsum(sizes)
            n = sizes[word]
            before = np.concatenate(([0], np.cumsum(n)))
            flat = ids[np.repeat(ends[word] - before[1:], n) + np.arange(before[-1])]
            bounds = before[np.cumsum([0, *map(len, texts)])].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], schema=_IDS_ARROW)
            if len(known) > WORDS or len(ids) > WORDS * 16:  # many words, or long ones
                known, ids, sizes = _numbers(), ids[: len(tail)], sizes[:1]

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return read.mapInArrow(encoded, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, ids, decoded) of (doc_id, ids); a null list decodes to ''."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_model(model)
        for part in slices(batches, 256):
            lists = part.column("ids").fill_null([]) if part.column("ids").null_count else part.column("ids")
            offsets = lists.offsets.to_numpy()
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, codec.decode_lists(ids, (offsets - offsets[0]).astype(np.int64))], schema=_TEXT_ARROW)

    read = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return read.mapInArrow(decoded, "doc_id long, ids array<int>, decoded string")
