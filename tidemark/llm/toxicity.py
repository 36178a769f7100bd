"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

1. A lexicon of toxic words and word stems (``STEMS`` first letters) is learned
   from labelled rows: entries whose log odds are high, ranked by their
   log-likelihood ratio, each counted once per distinct text.
2. Every text becomes a short dense vector: lexicon densities, how near second
   person pronouns stand to lexicon words, and rates of capitals, punctuation
   and obfuscation (digits or symbols inside words, stretched letters, words
   that are in the lexicon once such symbols are read as letters).
3. Boosted trees are fitted on one part of the labelled rows, and isotonic
   regression maps their margin to a probability on the other part.

The parts are cut within each class, by rank of a hash, so both hold both classes
as soon as each class has two rows. The lexicon is learned from both, so the part
that calibrates knows it a little better than an unseen text would; learned from
the trees' part alone it misses too much where labels are few (README). Steps 1 and 3 use at
most ``LEXICON_ROWS`` and ``FIT_ROWS`` labelled rows a class on average, drawn by a
hash of the doc_id and weighted back; features and scores cover whole texts of all
rows. Only the text is an input of a score.

Defined results: null texts count as empty, and empty texts are scored like any
other; null labels are ignored, and of several labels of a doc_id the largest
counts; where a class has fewer than two labelled rows with a text there is nothing
to calibrate with, and every score is the share of label 1 among them (0 without
labels); a very long text is one text like any other, equal texts score equally,
and rows that repeat a doc_id are scored each; other columns of the input,
whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, slices

LEXICON_ROWS = 4000
FIT_ROWS = 20_000
LEXICON = 128  # entries
LEAST_TEXTS = 3  # toxic texts that an entry stands in
LOG_ODDS, LIKELIHOOD = 2.0, 12.0  # that it reaches at least
STEMS = (4, 5, 6)
TREES, DEPTH = 20, 3
TREES_SHARE = 0.7  # of the labelled rows; the others calibrate

# Second person pronouns of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus".split()
)
# Symbols read as letters.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasii")
_WORD = re.compile(r"\w+")
_MIXED = re.compile(r"[\d@$!|*#](?<=[^\W\d_].)[\w@$!|*#]*[^\W\d_]")  # a letter stands before; the symbol is sought first, as it is rarer
_TRIPLED = re.compile(r"(.)\1\1")
_LETTER = re.compile(r"[^\W\d_]")
_SYMBOLS = re.compile(r"[\w@$!|]+")
NAMES = (
    "log_words", "hit_density", "hit_words", "hit_weight", "densest", "second_density", "near_second", "capitals", "capital_words",
    "exclaims", "questions", "punctuation", "repeated_marks", "mixed_words", "stretched", "disguised_hits", "mean_word",
)
_MARKS = re.compile(r"[!?]{2,}")
_PUNCTUATION = re.compile(r"[^\w\s]")
_CAPITAL, _MARK = 1, 2  # classes of characters
_CLASS_OF: list[np.ndarray] = []
_ASCII_SPACES = "".join(c if _WORD.match(c) else " " for c in map(chr, range(128)))
_SPAN = 50  # words of the densest stretch


class Lexicon(dict):
    """Word to weight: the largest of the entries it is, or begins with (those that end in ``*``); 0 if none.

    Holds the weights of words asked for, at most ``KEPT`` of them.
    """

    KEPT = 200_000

    def __init__(self, entries: dict[str, float]):
        super().__init__()
        self._entries = entries
        self._heads = {entry[: STEMS[0]] for entry in entries if entry.endswith("*")}

    def hits(self, words: list[str]) -> set[str]:
        """The different words that have a weight; one that is no entry and begins like none is not looked up."""
        entries, heads, head = self._entries, self._heads, STEMS[0]
        return {w for w in set(words) if (w in entries or w[:head] in heads) and self[w]}

    def __missing__(self, word: str) -> float:
        get = self._entries.get
        weight = max(get(word, 0.0), *(get(word[:n] + "*", 0.0) for n in STEMS if len(word) >= n), 0.0)
        if len(self) >= self.KEPT:
            self.clear()
        self[word] = weight
        return weight


def _capitals_and_punctuation(text: str) -> tuple[int, int]:
    """How many characters are capitals, and how many neither words' nor spaces."""
    if not _CLASS_OF:
        every = map(chr, range(sys.maxunicode + 1))
        _CLASS_OF.append(np.fromiter((_CAPITAL * c.isupper() + _MARK * bool(_PUNCTUATION.match(c)) for c in every), np.uint8))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = _CLASS_OF[0][codes]
    # A circled capital is both.
    return int(np.count_nonzero(found & _CAPITAL)), int(np.count_nonzero(found & _MARK))


def _words(text: str) -> list[str]:
    """The matches of ``\\w+``."""
    return text.translate(_ASCII_SPACES).split() if text.isascii() else _WORD.findall(text)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    text = text or ""
    lower = text.lower()
    words = _words(lower)
    n = max(1, len(words))
    hot = lexicon.hits(words)
    hits = [i for i, w in enumerate(words) if w in hot] if hot else []
    second = [] if SECOND_PERSON.isdisjoint(words) else [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near, j = 0.0, 0
    for i in hits:  # nearness of the closest pronoun to any hit
        while j + 1 < len(second) and abs(second[j + 1] - i) <= abs(second[j] - i):
            j += 1
        if second:
            near = max(near, 1.0 / (1 + abs(second[j] - i)))
    densest, a = 0, 0
    for b, i in enumerate(hits):
        while i - hits[a] >= _SPAN:
            a += 1
        densest = max(densest, b - a + 1)
    upper, punctuation = _capitals_and_punctuation(text)
    shouted = sum(1 for w in _words(text) if len(w) > 1 and w.isupper()) if upper else 0
    mixed = _MIXED.findall(lower)
    disguised = sum(1 for w in _SYMBOLS.findall(lower) if not lexicon[w] and lexicon[w.translate(LOOKALIKES)]) if mixed else 0
    chars = max(1, len(text))
    return [
        math.log1p(len(words)), len(hits) / n, float(len(hot)), max(map(lexicon.__getitem__, hot), default=0.0),
        float(densest), len(second) / n, near, upper / chars, shouted / n, text.count("!") / n, text.count("?") / n,
        punctuation / chars, len(_MARKS.findall(text)) / n, len(mixed) / n, len(list(filter(_LETTER.match, _TRIPLED.findall(lower)))) / n,
        float(disguised), sum(map(len, words)) / n,
    ]


def _draw(salt: int) -> Column:
    """A uniform number in [0, 1) by the doc_id."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(salt)), 11) / F.lit(float(1 << 53))


def clean_labels(labels: DataFrame, trainable: Column) -> DataFrame:
    """(doc_id, label): the largest non-null label of each trainable doc_id."""
    kept = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & trainable)
    return kept.groupBy("doc_id").agg(F.max(F.col("toxic")).cast("double").alias("label"))


def draw_rows(labels: DataFrame, rows: int, salt: int) -> DataFrame:
    """``labels`` thinned to ``rows`` a class on average, with ``weight`` = 1 / share drawn."""
    counts = {r.label: r.n for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, rows / n))).otherwise(share)
    return labels.where(_draw(salt) < share).withColumn("weight", 1.0 / F.greatest(share, F.lit(1e-12)))


def with_folds(sample: DataFrame) -> DataFrame:
    """``sample`` (at most about ``FIT_ROWS`` rows a class) with ``fold``: trees for TREES_SHARE of each class, calibration for the rest."""
    of_class = Window.partitionBy("label")
    rank, n = F.row_number().over(of_class.orderBy(_draw(3), "doc_id")), F.count(F.lit(1)).over(of_class)
    last = F.greatest(F.lit(1), F.least(n - 1, F.round(n * TREES_SHARE).cast("long")))
    return sample.withColumn("fold", F.when(rank <= last, "trees").otherwise("calibration"))


def learn_lexicon(docs: DataFrame, labels: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Entry to log odds, from the texts of ``docs`` that ``labels`` (doc_id, label) names."""
    named = materialize(labels.select("doc_id", "label"), "lexicon-labels")  # small: Spark broadcasts it, by its size
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    texts = docs.select("doc_id", text.alias("text")).join(named, "doc_id").dropDuplicates(["text", "label"])
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?U)\w+"), F.lit(0)))
    stems = [F.transform(F.filter("words", lambda w: F.length(w) >= F.lit(n)), lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS]
    entries = texts.select("label", words.alias("words")).select("label", F.explode(F.array_distinct(F.concat("words", *stems))).alias("entry"))
    t, c = F.col("t"), F.col("c")
    toxic, clean = (F.count(F.when(F.col("label") == k, 1)).cast("double") for k in (1.0, 0.0))
    totals = {r.label: r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    a, b = float(totals.get(1.0, 0)), float(totals.get(0.0, 0))
    odds = F.log((t + 0.5) / (a - t + 0.5)) - F.log((c + 0.5) / (b - c + 0.5))
    expected = (t + c) * (a / max(1.0, a + b))
    ratio = 2 * (t * F.log(t / expected) + F.when(c > 0, c * F.log(c / (t + c - expected))).otherwise(0.0))
    ranked = (
        entries.groupBy("entry")
        .agg(toxic.alias("t"), clean.alias("c"))
        .where(t >= LEAST_TEXTS)
        .select("entry", odds.alias("odds"), ratio.alias("ratio"))
        .where((F.col("odds") >= LOG_ODDS) & (F.col("ratio") >= LIKELIHOOD))
        .orderBy(F.desc("ratio"), "entry")
        .limit(size)
    )
    return {r.entry: r.odds for r in ranked.collect()}


def text_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """(doc_id, features) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lexicon(lexicon)
        for batch in slices(batches):
            rows = [features(t, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "features"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, features array<double>")


def score_toxicity(docs: DataFrame, labels: DataFrame, trainable: Column) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text).

    ``labels`` has (doc_id, toxic); ``trainable`` is a condition on its doc_id.
    """
    known = materialize(clean_labels(labels, trainable).join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "toxic-labels")
    sample = materialize(with_folds(draw_rows(known, FIT_ROWS, 2)), "toxic-sample")
    lexicon = learn_lexicon(docs, draw_rows(known, LEXICON_ROWS, 1))
    table = materialize(text_features(docs, lexicon), "toxic-features")
    # By doc_id, also where rows repeat one: each of them is an example.
    rows = materialize(table.join(sample, "doc_id"), "toxic-rows")
    found = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(found.get(0.0, 0), found.get(1.0, 0)) < 2:
        share = found.get(1.0, 0) / max(1, sum(found.values()))
        return table.select("doc_id", F.lit(float(share)).alias("score"))
    vector = array_to_vector("features").alias("vector")
    trees = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7)
    model = trees.fit(rows.where("fold = 'trees'").select(vector, "label", "weight"))

    def with_margin(frame: DataFrame, *columns: str) -> DataFrame:
        scored = model.transform(frame.select(*columns, vector))
        return scored.select(*columns, vector_to_array("rawPrediction")[1].alias("margin"))

    steps = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight", predictionCol="score")
    calibrated = steps.fit(with_margin(rows.where("fold = 'calibration'"), "label", "weight"))
    scored = calibrated.transform(with_margin(table, "doc_id"))
    return scored.select("doc_id", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))
