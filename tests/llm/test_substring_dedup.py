import random

import pytest

from tidemark.llm import hashing
from tidemark.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id long, text string, slice string, n_words string"


def brute(docs, window):
    words = {k: (t or "").encode().split() for k, (_, t) in enumerate(docs)}
    first = {}
    for k, (i, _) in enumerate(docs):
        for s in range(len(words[k]) - window + 1) if i is not None else ():
            g = tuple(words[k][s : s + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for k, (i, _) in enumerate(docs):
        gone = set()
        for s in range(len(words[k]) - window + 1) if i is not None else ():
            if first[tuple(words[k][s : s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(words[k]), len(gone), b" ".join(w for p, w in enumerate(words[k]) if p not in gone).decode()))
    return sorted(out, key=str)


def run(spark, docs, window, **kw):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)
    rows = remove_repeats(df, window=window, **kw).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in rows), key=str)


@pytest.mark.parametrize("window,seed", [(13, 0), (13, 1), (6, 2), (3, 3)])
def test_against_brute_force(spark, window, seed):
    r = random.Random(seed)
    passages = [" ".join(r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(r.randrange(5, 40))) for _ in range(6)]
    docs = []
    for i in range(60):
        bits = [r.choice(passages) if r.random() < 0.4 else " ".join(f"w{r.randrange(400)}" for _ in range(r.randrange(30))) for _ in range(4)]
        docs.append((r.randrange(80), r.choice([" ", "\n", "\t  "]).join(bits)))
    docs += [(None, docs[0][1]), (3, None), (4, ""), (5, " \n "), (90, docs[1][1]), (90, docs[1][1]), (91, "a " * 500)]
    assert run(spark, docs, window, slices=5, buckets=7) == brute(docs, window)


def test_long_text_crosses_segments(spark, monkeypatch):
    r = random.Random(5)
    long = " ".join(str(r.randrange(10**9)) for _ in range(300_000))
    part = " ".join(long.split()[150_000:150_100])
    got = run(spark, [(1, long), (2, "x " + part + " y"), (3, "z" * 3_000_000)], 13)
    assert got == [(1, 300_000, 0, long), (2, 102, 100, "x y"), (3, 1, 0, "z" * 3_000_000)]


def test_empty_table(spark):
    assert run(spark, [], 13) == []
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame([], SCHEMA), window=2)


def test_words_hash_alike_wherever_they_stand(monkeypatch):
    monkeypatch.setattr(hashing, "_SEGMENT", 64)
    texts = [b"alpha beta  gamma\n", b"", b"beta " * 100, b"x" * 500 + b" gamma"]
    h, bounds = hashing.hash_words(texts)
    assert list(hashing.np.diff(bounds)) == [3, 0, 100, 2]
    assert h[1] == h[3] == h[102] and h[2] == h[-1] and len(set(h.tolist())) == 4
