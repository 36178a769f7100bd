import math
import random
import re
from fractions import Fraction

import pytest

from tidemark.llm.source_mixing import mix_sources, token_targets

SCHEMA = "doc_id long, text string, source string, size string, n string, of string"


def run(spark, docs, **kw):
    df = spark.createDataFrame([(i, t, s, "c", "c", "c") for i, t, s in docs], SCHEMA)
    return sorted((tuple(r)[:7] for r in mix_sources(df, **kw).collect()), key=str)


def brute_targets(sizes, weights, share):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = Fraction(share) * sum(sizes.values()) - sum(fixed.values())
        now = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if now[s] > 2 * sizes[s]]
        if not over:
            return {**fixed, **now}
        fixed.update({s: 2 * sizes[s] for s in over})


@pytest.mark.parametrize("seed", range(6))
def test_targets_against_brute_force(seed):
    r = random.Random(seed)
    sizes = {s: r.choice([0, 3, 50, 10_000]) + r.randrange(40) for s in ["b", "a", "é", "\U0001f600", "￿", "", None][: r.randrange(1, 8)]}
    want = brute_targets(sizes, (3, 1, 2), 1.5)
    got = token_targets(sizes, (3, 1, 2), 1.5)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-9) for s in want)


def corpus(r, n=900):
    docs = []
    for i in range(n):
        source = r.choice(["hot"] * 6 + ["a", "b", "c", None])
        size = 7 if r.random() < 0.3 else min(4000, int(math.exp(r.gauss(4, 1.3))))
        docs.append((i, " ".join("w" for _ in range(size)), source))
    return docs


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = corpus(random.Random(1)) + [(5000, None, "a"), (5001, "", None), (5001, " \t\n", "b"), (None, "x y", "a"), (None, None, None)]
    rows = run(spark, docs)
    assert rows == run(spark, docs[::-1])
    sizes = {}
    for i, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    target, taken = brute_targets(sizes, (3, 1, 2), 1.5), dict.fromkeys(sizes, 0)
    assert len(rows) == len(docs)
    for doc_id, source, size, source_size, goal, rate, copies in rows:
        assert source_size == sizes[source] and math.isclose(goal, target[source], rel_tol=1e-9)
        assert 0 <= copies <= 2 and 0 <= rate <= 2 and (size > 0 or copies == 0) and abs(copies - rate) < 2
        taken[source] += copies * size
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2, (s, taken[s], target[s])


def test_rates_are_tilted_exponentially(spark):
    rows = [r for r in run(spark, corpus(random.Random(2))) if r[1] == "hot" and 0 < r[5] < 2]
    assert len(rows) > 50
    (a, b), *_, (c, d) = sorted({(r[2], math.log(r[5])) for r in rows})
    slope = (d - b) / (c - a)
    assert all(math.isclose(math.log(r[5]), b + slope * (r[2] - a), rel_tol=1e-6, abs_tol=1e-6) for r in rows)
    tokens = sum(r[2] * r[5] for r in run(spark, corpus(random.Random(2))) if r[1] == "hot")
    assert math.isclose(tokens, rows[0][4], rel_tol=1e-6)


def test_tilt_follows_the_target(spark):
    """Above its own size a source favours long documents, below it short ones; neither rate is flat."""
    docs = [(i, "w " * (1 + i % 40), "ab"[i % 2]) for i in range(800)]
    rows = run(spark, docs, weights=(1, 4), share=0.8)
    for source, sign in (("a", -1), ("b", 1)):
        mine = [r for r in rows if r[1] == source]
        assert sign * (mine[0][4] - mine[0][3]) > 0
        free = sorted({(r[2], math.log(r[5])) for r in mine if 0 < r[5] < 2})
        slopes = [(y - x) / (d - c) for (c, x), (d, y) in zip(free, free[1:])]
        assert len(slopes) > 5 and all(sign * s > 1e-3 and math.isclose(s, slopes[0], rel_tol=1e-6) for s in slopes)
        # nearest to rate 1: the line of log rates goes through 0 at size 0
        assert all(math.isclose(y, slopes[0] * c, rel_tol=1e-6) for c, y in free)
        assert math.isclose(sum(r[2] * r[5] for r in mine), mine[0][4], rel_tol=1e-8)
        assert abs(sum(r[2] * r[6] for r in mine) - mine[0][4]) <= 2


def test_a_source_without_weight_is_left_out(spark):
    rows = run(spark, [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(60)], weights=(0, 1), share=0.5)
    assert all(r[4] == r[5] == r[6] == 0 for r in rows if r[1] == "a") and sum(r[6] for r in rows) > 0


def test_copies_spread_over_a_stratum_of_equal_documents(spark):
    rows = run(spark, [(i, "a b c", "s") for i in range(501)] + [(9999, "a b c", "t")])
    assert sum(r[6] for r in rows if r[1] == "s") in (751, 750) and {r[6] for r in rows if r[1] == "s"} == {1, 2}


def test_all_at_their_limit_no_words_and_empty(spark):
    rows = run(spark, [(1, "a b", "x"), (2, "c", "y")], share=2.0)
    assert [r[6] for r in rows] == [2, 2]
    assert [(r[4], r[6]) for r in run(spark, [(1, None, "x"), (2, "", None)])] == [(0.0, 0), (0.0, 0)]
    assert run(spark, []) == []


def test_one_very_long_document(spark):
    rows = run(spark, [(1, "w " * 300_000, "x"), (2, "w " * 10, "x"), (3, "w " * 300_000, "y")])
    assert sum(r[6] * r[2] for r in rows) >= 300_000


def test_rows_of_one_id_and_empty_ones_are_whole(spark):
    """Most rows share an id (or have none): each is a row of the result, targets are met, empty ones are never taken."""
    r = random.Random(8)
    docs = [(r.choice([None, None, 7, i]), " ".join(f"w{i}x{k}" for k in range(r.choice([0, 4, 4, 9]))), r.choice("ab")) for i in range(600)]
    docs += [(None, None, "a")] * 40 + [(7, "same words here", "b")] * 30
    got = run(spark, docs)
    assert len(got) == len(docs) and got == run(spark, docs[::-1])
    for source in "ab":
        rows = [x for x in got if x[1] == source]
        taken = sum(x[2] * x[6] for x in rows)
        assert abs(taken - rows[0][4]) <= 9 and all(x[6] == 0 for x in rows if x[2] == 0) and all(0 <= x[6] <= 2 for x in rows)
