"""Language identification with blended-spectrum string kernels.

The kernel of two texts is the number of character n-grams (n = 1, 2, 3) that
stand in both, over the geometric mean of how many stand in each. Landmarks from
every language give a Nyström map: the kernel against the landmarks, whitened by
the landmarks' own kernel matrix. One ridge regression per language on that map
(one versus rest) is the classifier; map and regressions fold into one matrix,
so a batch of texts is scored by two matrix products (presence x landmarks,
kernel x weights).

The model is fitted on a bounded sample of labelled rows: ``SAMPLE`` rows a
language on average, drawn by a hash of the doc_id, the ``LANDMARKS`` a language
with the smallest hashes being landmarks. n-grams are hashed to ``DIMENSIONS``.
So the model has at most 4 x DIMENSIONS x LANDMARKS bytes a language (float32),
whatever the corpus. Predictions use the whole text and nothing else.

The scores of a text always sum to the same number, so the best cannot tell a
text of a language that was not learned. Its coverage can: the share of its
n-grams that stand in a landmark. A language's least coverage is LEEWAY times
what all but FEW of its held-out examples reach; those that are no landmarks are
held out, a landmark is compared with the others. With ``reject``, a prediction
of less coverage is ``und``.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
as is every text when nothing could be learned, and with ``reject`` a text of too
little coverage; rows without language or text
are never learned from; of equal scores the language that is first in order of
name counts; a very long text is predicted whole; an empty table gives no rows, and
no model; other columns of the input, whatever their names, are not read; letters are compared in lower case, runs of other
characters count as one space; rows that repeat a doc_id are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import slices

UNKNOWN = "und"
DIMENSIONS = 1 << 18
SAMPLE = 300
LANDMARKS = 24
RIDGE = 1e-2
FEW = 0.01  # of a language's held-out examples, which may be foreign or junk themselves
LEEWAY = 0.75
_BATCH = 128  # texts of a matrix product
_SPACE = 32
_IS_LETTER: list[np.ndarray] = []


def _letters(codes: np.ndarray) -> np.ndarray:
    if not _IS_LETTER:
        _IS_LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000))
    out = _IS_LETTER[0][np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes > 0xFFFF)
    out[beyond] = [chr(c).isalpha() for c in codes[beyond].tolist()]
    return out


class Grams:
    """n-gram ids of texts; holds the work array that tells ids seen before from new ones."""

    def __init__(self) -> None:
        self._last = np.zeros(DIMENSIONS, dtype=np.int64)

    def __call__(self, text: str | None) -> np.ndarray:
        """Distinct n-gram ids of a text; none if it has no letter."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters(codes)
        if not letter.any():
            return np.zeros(0, dtype=np.int64)
        clean = np.where(letter, codes, _SPACE)
        clean = clean[letter | np.concatenate(([False], letter[:-1]))]  # one space after a run of letters
        clean = np.concatenate(([_SPACE], clean, [_SPACE] if letter[-1] else [])).astype(np.uint64)
        one = clean * np.uint64(0x9E3779B97F4A7C15)
        two = (clean[:-1] + (clean[1:] << np.uint64(21))) * np.uint64(0xBF58476D1CE4E5B9)
        three = (clean[:-2] + (clean[1:-1] << np.uint64(21)) + (clean[2:] << np.uint64(42))) * np.uint64(0x94D049BB133111EB)
        ids = (np.concatenate((one, two, three)) >> np.uint64(64 - 18)).astype(np.int64)
        place = np.arange(len(ids))
        self._last[ids] = place  # the last place of each id wins, so each id is kept once
        return ids[self._last[ids] == place]


@dataclass
class LanguageModel:
    """``column`` maps n-gram ids to rows of ``landmarks`` (presence), -1 for those in no landmark; ``least``: coverage by class."""

    classes: list[str]
    column: np.ndarray
    landmarks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray
    least: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def coverage(self, ids: np.ndarray) -> float:
        """Share of a text's n-grams that stand in a landmark."""
        return float((self.column[ids] >= 0).mean()) if len(ids) else 0.0

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        presence = np.zeros((len(sets), len(self.landmarks)), dtype=np.float32)
        for i, ids in enumerate(sets):
            at = self.column[ids]
            presence[i, at[at >= 0]] = 1.0
        size = np.array([max(1, len(ids)) for ids in sets], dtype=np.float64)
        return (presence @ self.landmarks) / np.sqrt(size[:, None] * self.sizes[None, :])

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        kernel = self.kernel(sets)
        return np.column_stack((kernel, np.ones(len(kernel)))) @ self.weights


def _least_coverage(model: LanguageModel, examples: list[tuple[str, np.ndarray]], landmarks: int) -> np.ndarray:
    """Per class of ``model``, the coverage under which a text is none of its own."""
    holders = model.landmarks.sum(axis=1)  # landmarks that hold the n-gram
    least = []
    for c in model.classes:
        own = [ids for lang, ids in examples if lang == c]
        seen = [float((holders[model.column[ids]] > 1).mean()) for ids in own[:landmarks]]
        rest = [model.coverage(ids) for ids in own[landmarks:]]
        least.append(LEEWAY * np.quantile(rest if len(rest) >= landmarks else rest + seen, FEW))
    return np.array(least)


def fit(examples: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """A model from (language, n-gram ids), the first ``landmarks`` of each language being its landmarks."""
    classes = sorted({lang for lang, _ in examples})
    marks = [ids for c in classes for ids in [x for lang, x in examples if lang == c][:landmarks]]
    used = np.unique(np.concatenate(marks)) if marks else np.zeros(0, dtype=np.int64)
    column = np.full(DIMENSIONS, -1, dtype=np.int32)
    column[used] = np.arange(len(used))
    table = np.zeros((len(used), len(marks)), dtype=np.float32)
    for j, ids in enumerate(marks):
        table[column[ids], j] = 1.0
    model = LanguageModel(classes, column, table, np.array([len(ids) for ids in marks], dtype=np.float64), np.zeros((0, 0)))
    if not classes:
        return model
    value, vector = np.linalg.eigh(model.kernel(marks))
    sound = value > 1e-6 * value.max()
    whiten = vector[:, sound] / np.sqrt(value[sound])
    phi = np.vstack([model.kernel([ids for _, ids in examples[a : a + _BATCH]]) for a in range(0, len(examples), _BATCH)]) @ whiten
    phi = np.column_stack((phi, np.ones(len(phi))))
    target = np.where(np.array([lang for lang, _ in examples])[:, None] == np.array(classes)[None, :], 1.0, -1.0)
    penalty = ridge * len(phi) * np.eye(phi.shape[1])
    penalty[-1, -1] = 0.0  # the intercept is free
    solved = np.linalg.solve(phi.T @ phi + penalty, phi.T @ target)
    model.weights = np.vstack((whiten @ solved[:-1], solved[-1:]))
    model.least = _least_coverage(model, examples, landmarks)
    return model


def fit_language_model(docs: DataFrame, trainable: Column, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> LanguageModel:
    """Fit on ``sample`` rows a language of ``docs`` (doc_id, text, lang) among those ``trainable``."""
    rows = docs.where(trainable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One row per language: their number does not follow the corpus.
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row.lang, F.lit(min(1.0, sample / row.n))).otherwise(share)
    drawn = rows.where(draw < share).select(F.col("lang").cast("string").alias("lang"), draw.alias("draw"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in slices(batches):
            ids = [grams(t).astype(np.int32).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), pa.array(ids, pa.binary())], ["lang", "draw", "ids"])

    examples = sorted((r.lang, r.draw, bytes(r.ids)) for r in drawn.mapInArrow(run, "lang string, draw double, ids binary").collect())
    return fit([(lang, np.frombuffer(ids, dtype=np.int32)) for lang, _, ids in examples if ids], landmarks)


def predict_language(docs: DataFrame, model: LanguageModel, keep: str = "doc_id", reject: bool = False) -> DataFrame:
    """(``keep``, lang_pred, score) for every row of ``docs``; ``keep`` is one of its columns, of any type.

    A ``keep`` that is a struct with a field ``text`` (a whole row) brings the
    text itself; otherwise ``docs`` has a column ``text``. ``reject``: texts of a
    language that was not learned, and junk, are ``und``.
    """
    kept = docs.schema[keep].dataType
    inside = isinstance(kept, StructType) and "text" in kept.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            lang, score = [], []
            texts = batch.column("kept").field("text") if inside else batch.column("text")
            for at in range(0, len(texts), _BATCH):
                sets = [grams(t) for t in texts.slice(at, _BATCH).to_pylist()]
                if not model.classes:
                    lang += [UNKNOWN] * len(sets)
                    score += [0.0] * len(sets)
                    continue
                found = model.scores(sets)
                best = found.argmax(axis=1)
                for ids, b, row in zip(sets, best.tolist(), found):
                    known = len(ids) and not (reject and model.coverage(ids) < model.least[b])
                    lang.append(model.classes[b] if known else UNKNOWN)
                    score.append(float(min(1.0, max(0.0, (1.0 + row[b]) / 2.0))) if known else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [keep, "lang_pred", "score"])

    rows = docs.select(F.col(keep).alias("kept"), *([] if inside else [F.col("text").cast("string").alias("text")]))
    schema = StructType([StructField(keep, kept), StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema)
