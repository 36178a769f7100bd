import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.language_id import DIMENSIONS, Grams, fit, fit_language_model, predict_language

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string, kept string"
WORDS = {"aa": "aba cab bac abba cacao".split(), "bb": "xyz zyx yxz zxxy yyzx".split(), "cc": "Été àçô éèê ôàé çéà".split()}


def corpus(r, n):
    out = []
    for i in range(n):
        lang = r.choice(list(WORDS))
        out.append((i, " ".join(r.choice(WORDS[lang]) for _ in range(r.randrange(1, 60))), lang))
    return out


def frame(spark, docs):
    return spark.createDataFrame([(*d, "c", "c", "c") for d in docs], SCHEMA)


def grams(text):
    """The distinct n-grams, as strings."""
    clean = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in clean:
        clean = clean.replace("  ", " ")
    return {clean[i : i + n] for n in (1, 2, 3) for i in range(len(clean) - n + 1)}


def test_presence_kernel_against_brute_force():
    r, g = random.Random(1), Grams()
    texts = ["".join(r.choice("abcé 1.\n\U00010400") for _ in range(r.randrange(1, 80))) + "a" for _ in range(40)]
    sets = [g(t) for t in texts]
    model = fit([("x" if i % 2 else "y", s) for i, s in enumerate(sets)], landmarks=20)
    order = [i for i in range(40) if i % 2] + [i for i in range(40) if not i % 2]
    kernel = model.kernel(sets)
    for i in range(40):
        a = grams(texts[i])
        assert len(sets[i]) == len(a) == len(np.unique(sets[i])) and sets[i].max(initial=0) < DIMENSIONS
        for j, k in enumerate(order):
            b = grams(texts[k])
            assert abs(kernel[i, j] - len(a & b) / (len(a) * len(b)) ** 0.5) < 1e-5


def test_held_out_accuracy(spark):
    r = random.Random(2)
    docs = frame(spark, corpus(r, 900))
    model = fit_language_model(docs, F.col("doc_id") % 5 != 0, sample=100, landmarks=8)
    assert len(model.sizes) == 24
    got = predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 5 = 0").collect()
    assert sum(x.lang_pred == x.lang for x in got) / len(got) > 0.99
    assert all(0.0 <= x.score <= 1.0 for x in got)


def test_edges(spark):
    r = random.Random(3)
    model = fit_language_model(frame(spark, corpus(r, 100) + [(7, None, "aa"), (8, "x", None), (None, "aba", "aa")]), F.lit(True))
    docs = [(1, None, None), (2, "", "aa"), (3, "12 ²³ _!", "aa"), (3, "aba cab", None), (None, "xyz", None), (5, "ab " * 500_000, None), (6, "漢字", None)]
    got = predict_language(frame(spark, docs), model).collect()
    assert got[0][1:] == got[1][1:] == got[2][1:] == ("und", 0.0)
    assert [x.lang_pred for x in got[3:6]] == ["aa", "bb", "aa"] and got[6].lang_pred in WORDS
    assert predict_language(frame(spark, []), model).count() == 0


def test_nothing_to_learn_from(spark):
    model = fit_language_model(frame(spark, [(1, "abc", None)]), F.lit(True))
    assert predict_language(frame(spark, [(1, "abc", "aa")]), model).first()[1:] == ("und", 0.0)


def test_fit_does_not_depend_on_row_order(spark):
    rows = corpus(random.Random(4), 200)
    one, two = (fit_language_model(frame(spark, x), F.lit(True), sample=30, landmarks=5) for x in (rows, rows[::-1]))
    assert np.array_equal(one.weights, two.weights)


@pytest.mark.parametrize("keep", ["doc_id", "text"])
def test_keeps_a_column(spark, keep):
    model = fit_language_model(frame(spark, corpus(random.Random(5), 60)), F.lit(True))
    docs = frame(spark, [(1, "aba", None), (2, None, None)])
    assert predict_language(docs, model, keep=keep).columns == [keep, "lang_pred", "score"]
    rows = docs.select(F.struct("lang", "text", "doc_id").alias("row"))
    whole = predict_language(rows, model, keep="row").collect()
    assert [(r.row.doc_id, r.lang_pred) for r in whole] == [(1, "aa"), (2, "und")]
