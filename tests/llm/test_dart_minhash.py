import random

import numpy as np
import pytest

from tidemark.llm import dart_minhash
from tidemark.llm.components import connected_components
from tidemark.llm.dart_minhash import near_duplicate_classes, signatures

SCHEMA = "doc_id long, text string, h string, node string, row string"


def shingle_set(text):
    w = (text or "").lower().encode().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(docs, threshold=0.8):
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(docs):
        ids = [x for x in (least.get(root(k)), i) if x is not None]
        least[root(k)] = min(ids, default=None)
    return sorted(((i, least[root(k)]) for k, (i, _) in enumerate(docs)), key=str)


def run(spark, docs):
    df = spark.createDataFrame([(i, t, "c", "c", "c") for i, t in docs], SCHEMA)
    return sorted(((r.doc_id, r.class_id) for r in near_duplicate_classes(df).collect()), key=str)


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return " ".join(words)


def test_classes_against_brute_force(spark):
    r = random.Random(4)
    docs = []
    for g in range(12):
        base = [f"w{r.randrange(5000)}" for _ in range(r.choice([6, 40, 150, 400]))]
        docs += [(1000 - len(docs), edited(r, base, r.choice([0, 0, 1, 2, 6, 12]))) for _ in range(5)]
    docs += [(0, docs[0][1]), (None, docs[0][1]), (2, docs[7][1].upper()), (2, "one two"), (3, "One\ttwo"), (4, "one two three")]
    docs += [(5, None), (6, ""), (7, " \n"), (None, None), (8, "w " * 2000), (9, "w " * 2500)]
    assert run(spark, docs) == brute(docs)


def test_a_text_meets_its_repetitions(spark):
    """Doubled or ten times over, a text has (nearly) the same set of shingles."""
    r = random.Random(9)
    docs = []
    for g in range(12):
        base = " ".join(f"g{g}w{r.randrange(5000)}" for _ in range(60 + 10 * g))
        docs += [(10 * g + m, " ".join([base] * m)) for m in (1, 2, 10)]
    got = run(spark, docs)
    assert got == brute(docs) and len({c for _, c in got}) == 12


def test_one_very_long_text(spark):
    words = [str(i) for i in range(120_000)]
    got = run(spark, [(1, " ".join(words)), (2, " ".join(words[:-5000])), (3, " ".join(words[:60_000]))])
    assert got == [(1, 1), (2, 1), (3, 3)]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_buckets_of_unlike_texts_are_settled(spark, monkeypatch):
    """One bucket for all: hubs find little, so the rounds have to compare everything."""
    monkeypatch.setattr(dart_minhash, "_band_keys", lambda s, bands, rows: np.zeros((len(s), 1), dtype=np.uint64))
    r = random.Random(8)
    docs = []
    for g in range(9):
        base = [f"g{g}w{i}" for i in range(80)]
        docs += [(g + 10 * c, edited(r, base, c)) for c in range(3)]
    assert run(spark, docs) == brute(docs)


@pytest.mark.parametrize("n", [1, 12, 300])
def test_signatures_estimate_weighted_jaccard(n):
    r = np.random.default_rng(n)
    a = r.integers(1, 1 << 62, n).astype(np.uint64)
    b = np.concatenate([a[: n - n // 4], r.integers(1, 1 << 62, n // 4).astype(np.uint64)])
    wa, wb = 1 + r.exponential(size=n), 1 + r.exponential(size=n)
    x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    both = x.keys() | y.keys()
    want = sum(min(x.get(e, 0), y.get(e, 0)) for e in both) / sum(max(x.get(e, 0), y.get(e, 0)) for e in both)
    k = 2000
    one, two = signatures([(a, wa), (b, wb)], k)
    assert abs((one == two).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5 + 1e-9
    alone = signatures([(b, wb)], k)[0]  # a signature does not depend on what it is computed with
    assert (alone == two).all()


def test_texts_of_one_template_do_not_meet_by_its_words(spark, monkeypatch):
    """Like enough to share buckets, too unlike to be duplicates: the join's rows grow with the texts, not with their square."""
    r = random.Random(11)
    template = [f"t{i}" for i in range(200)]
    docs = [(i, " ".join(template + [f"d{i}w{r.randrange(9**9)}" for _ in range(25 + i % 20)])) for i in range(120)]
    docs += [(200 + i, docs[i][1] + " more") for i in range(3)]
    joined, sides = [], dart_minhash._sides

    def counting(ranked, threshold):
        one, two = sides(ranked, threshold)
        joined.append(one.join(two, ["token", "length"]).count())
        return one, two

    monkeypatch.setattr(dart_minhash, "_sides", counting)
    # One bucket for all: hubs link nothing, so every text is an open component.
    monkeypatch.setattr(dart_minhash, "_band_keys", lambda s, bands, rows: np.zeros((len(s), 1), dtype=np.uint64))
    assert run(spark, docs) == brute(docs)
    assert joined[0] <= 20 * len(docs)


@pytest.mark.parametrize("seed", range(3))
def test_settled_pairs_of_all_lengths(spark, monkeypatch, seed):
    """Cut, lengthened and edited texts about the threshold, all in one bucket."""
    r = random.Random(seed)
    monkeypatch.setattr(dart_minhash, "_band_keys", lambda s, bands, rows: np.zeros((len(s), 1), dtype=np.uint64))
    docs = []
    for g in range(25):
        base = [f"g{g}w{i}" for i in range(r.choice([5, 9, 30, 60, 200]))]
        for c in range(4):
            cut = base[: max(1, int(len(base) * r.uniform(0.78, 1)))]
            docs.append((len(docs), edited(r, cut, r.choice([0, 0, 1, 2]))))
    assert run(spark, docs) == brute(docs)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
