import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.toxicity import NAMES, Lexicon, clean_labels, draw_rows, features, learn_lexicon, score_toxicity, with_folds

DOCS = "doc_id long, text string, label string, score string, features string, weight string"
LABELS = "doc_id long, quality int, toxic int, label string"


def corpus(r, n):
    docs, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.2
        words = [f"w{r.randrange(300)}" for _ in range(r.randrange(5, 60))]
        for _ in range(r.randrange(1, 4) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(["zounds", "gadzooks", "blatherx", "blathery", "blatherz"]))
        docs.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    d = spark.createDataFrame([(*x, "c", "c", "c", "c") for x in docs], DOCS)
    return d, spark.createDataFrame([(i, 0, t, "c") for i, t in labels], LABELS)


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus(random.Random(1), 3000)
    extra = [(9000, None), (9001, ""), (9001, "zounds gadzooks"), (None, "w1 zounds"), (9002, "w1 " * 100_000)]
    d, l = frames(spark, docs + extra, labels + [(9000, None), (9100, 1), (None, 1)])
    return docs, score_toxicity(d, l, F.col("doc_id") % 3 != 1).collect()


def test_held_out_accuracy_and_every_row_scored(scored):
    docs, rows = scored
    bad = ("zounds", "gadzooks", "blather")
    by = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(docs) + 5 and all(0.0 <= r.score <= 1.0 for r in rows)
    held = [(i, any(b in t for b in bad)) for i, t in docs if i % 3 == 1]
    assert sum((by[i] >= 0.7) == toxic for i, toxic in held) / len(held) > 0.97
    assert by[9000] < 0.5 and by[9002] < 0.5 and max(r.score for r in rows if r.doc_id == 9001) > 0.7


def test_lexicon_has_words_and_stems(spark):
    docs, labels = corpus(random.Random(2), 2000)
    d, l = frames(spark, docs, labels)
    entries = learn_lexicon(d, clean_labels(l, F.lit(True)))
    assert {"zounds", "gadzooks", "blat*"} <= entries.keys()
    lexicon = Lexicon(entries)
    assert lexicon["blatherunseen"] > 0 and lexicon["zounds"] > 0 and lexicon["w1"] == 0


def test_features():
    lexicon = Lexicon({"idiot": 3.0})
    got = dict(zip(NAMES, features("YOU idiot!! an id1ot, soooo", lexicon)))
    assert got["near_second"] == 0.5 and got["hit_words"] == 1 and got["hit_weight"] == 3.0 and got["disguised_hits"] == 1
    assert got["capital_words"] > 0 and got["repeated_marks"] > 0 and got["stretched"] > 0 and got["mixed_words"] > 0
    assert len(features(None, lexicon)) == len(features("", lexicon)) == len(NAMES)
    near = dict(zip(NAMES, features("you " + "x " * 9 + "idiot " + "x " * 3 + "you", lexicon)))["near_second"]
    assert near == 1 / 5
    assert dict(zip(NAMES, features("idiot " + "x " * 60 + "idiot x idiot", lexicon)))["densest"] == 2


def test_labels_of_one_class_none_and_empty(spark):
    d, l = frames(spark, [(1, "a"), (2, "b")], [(1, 1), (2, 1), (2, 0)])
    assert [r.score for r in score_toxicity(d, l, F.lit(True)).collect()] == [1.0, 1.0]
    assert [r.score for r in score_toxicity(d, l.limit(0), F.lit(True)).collect()] == [0.0, 0.0]
    assert score_toxicity(d.limit(0), l, F.lit(True)).count() == 0


def test_largest_label_of_a_document_counts(spark):
    _, l = frames(spark, [], [(1, 0), (1, 1), (2, None), (2, 0), (3, None)])
    assert sorted(tuple(r) for r in clean_labels(l, F.lit(True)).collect()) == [(1, 1.0), (2, 0.0)]


def test_folds_are_cut_within_each_class(spark):
    _, l = frames(spark, [], [(i, int(i < toxic)) for toxic in (3,) for i in range(60)])
    folded = with_folds(draw_rows(clean_labels(l, F.lit(True)), 1000, 2)).groupBy("label", "fold").count().collect()
    assert {(r.label, r.fold): r["count"] for r in folded} == {(0.0, "trees"): 40, (0.0, "calibration"): 17, (1.0, "trees"): 2, (1.0, "calibration"): 1}


@pytest.mark.parametrize("toxic", [1, 2, 3, 8])
def test_few_labels_of_a_class(spark, toxic):
    """One toxic label is nothing to calibrate with; from two on the scores are the model's."""
    docs = [(i, f"w{i % 7} common words {'zounds gadzooks !!' if i < toxic else ''}") for i in range(60)]
    d, l = frames(spark, docs, [(i, int(i < toxic)) for i in range(60)])
    scores = {r.doc_id: r.score for r in score_toxicity(d, l, F.lit(True)).collect()}
    if toxic == 1:
        assert set(scores.values()) == {1 / 60}
    else:
        assert min(scores[i] for i in range(toxic)) > 0.7 > 0.3 > max(scores[i] for i in range(toxic, 60))


def test_scores_are_calibrated_on_unseen_rows(spark):
    """Words that only lean towards toxic: on held-out rows the mean score of a group is near its share of toxic labels."""
    r = random.Random(11)
    docs, truth = [], {}
    for i in range(4000):
        hits = r.randrange(4)
        truth[i] = int(r.random() < (0.02, 0.3, 0.7, 0.95)[hits])
        words = [f"w{r.randrange(200)}" for _ in range(20)] + [r.choice(["zounds", "gadzooks", "blather"]) for _ in range(hits)]
        r.shuffle(words)
        docs.append((i, " ".join(words)))
    d, l = frames(spark, docs, [(i, truth[i]) for i in range(4000) if i % 3 != 1])
    scores = {x.doc_id: x.score for x in score_toxicity(d, l, F.lit(True)).collect()}
    held = [i for i in range(4000) if i % 3 == 1]
    groups = [[i for i in held if low <= scores[i] < low + 0.25 or low == 0.75 and scores[i] == 1] for low in (0, 0.25, 0.5, 0.75)]
    error = sum(abs(sum(scores[i] - truth[i] for i in g)) for g in groups) / len(held)
    assert error < 0.05


def test_features_against_brute_force():
    """Counts and densities by a plain loop over the words."""
    r = random.Random(4)
    lexicon = {"idiot": 3.0, "fool": 2.0, "moro*": 1.5}
    for _ in range(200):
        words = [r.choice(["you", "YOUR", "idiot", "Fool", "moron", "tree", "house!!", "id1ot", "sooo", "a", "?", "du"]) for _ in range(r.randrange(30))]
        text = " ".join(words)
        got = dict(zip(NAMES, features(text, Lexicon(lexicon))))
        plain = [w.lower().strip("!") for w in words if w != "?"]
        hit = [i for i, w in enumerate(plain) if w in ("idiot", "fool", "moron")]
        second = [i for i, w in enumerate(plain) if w in ("you", "your", "du")]
        n = max(1, len(plain))
        assert got["hit_density"] == len(hit) / n and got["hit_words"] == len({plain[i] for i in hit}) and got["second_density"] == len(second) / n
        assert got["near_second"] == max((1 / (1 + abs(i - j)) for i in hit for j in second), default=0.0)
        assert got["densest"] == max((sum(1 for j in hit if i <= j < i + 50) for i in hit), default=0)
        assert got["capitals"] == sum(c.isupper() for c in text) / max(1, len(text))
        assert got["disguised_hits"] == plain.count("id1ot") and got["repeated_marks"] == words.count("house!!") / n


@pytest.mark.parametrize("seed", range(3))
def test_counts_of_a_text_against_plain_patterns(seed):
    """Words, capitals, marks, stretched and mixed words are what their definitions find, in any script."""
    r = random.Random(seed)
    for _ in range(400):
        text = "".join(r.choice("aAbB1@$!|*#_ .?\n\x1c\x85\u00a0\u00e9\u00c9\u00df\u0130\u0131\u24b6\u01c5\u03a3\u6f22\U0001f642\u0663'") for _ in range(r.randrange(60)))
        if r.random() < 0.5:
            text = text.encode("ascii", "ignore").decode()
        got, lower = dict(zip(NAMES, features(text, Lexicon({"ab": 1.0})))), text.lower()
        words, chars = re.findall(r"\w+", lower), max(1, len(text))
        n = max(1, len(words))
        assert got["hit_density"] == words.count("ab") / n and got["mean_word"] == sum(map(len, words)) / n
        assert got["capitals"] == sum(c.isupper() for c in text) / chars
        assert got["capital_words"] == sum(len(w) > 1 and w.isupper() for w in re.findall(r"\w+", text)) / n
        assert got["punctuation"] == len(re.findall(r"[^\w\s]", text)) / chars
        assert got["stretched"] == len(re.findall(r"([^\W\d_])\1\1", lower)) / n
        assert got["mixed_words"] == len(re.findall(r"[^\W\d_][\d@$!|*#][\w@$!|*#]*[^\W\d_]", lower)) / n
