import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import source_divergence as audit
from tidemark.llm.source_divergence import audit_sources, count_terms, radix_order

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(rows, least=3, top=200):
    rows = [((lang or ""), (source or ""), terms_of(text)) for text, lang, source in rows]
    out = []
    for lang in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == lang]
        held = Counter(t for r in own for t in set(r[2]))
        kept = {t for t, n in held.items() if n >= least}
        counts = {s: Counter() for s in sorted({r[1] for r in own})}
        for _, s, w in own:
            counts[s].update(t for t in w if t in kept)

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        whole = sum(counts.values(), Counter())
        for s, c in counts.items():
            pairs = [(other, sum((share(c, t) - share(d, t)) ** 2 // share(d, t) for t in kept)) for other, d in counts.items() if other != s]
            beyond = [(t, share(c, t), share(whole, t)) for t in kept if c[t] > 0]
            beyond = [(t, (p - q) ** 2 // q) for t, p, q in beyond if p > q]
            for part, items, limit in (("pair", pairs, None), ("term", beyond, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def run(spark, rows, **settings):
    # Extra columns named like those the operator makes.
    schema = "text string, lang string, source string, term string, n string, docs string, item string, total string, block string"
    docs = spark.createDataFrame([(*r, *"cccccc") for r in rows], schema)
    found = audit_sources(docs, **settings)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def corpus(seed, n=150):
    r = random.Random(seed)
    words = ["a", "The", "exactly8", "ninechars", "sixteencharacter", "seventeencharactr", "x" * 40, "é", "naïve", "漢字かな", "ÄÖ", "İ", "o" * 300]
    words += ["".join(r.choice("abCé") for _ in range(r.randrange(1, 24))) for _ in range(120)]
    rows = []
    for i in range(n):
        text = r.choice([" ", "_", "1", "\x00", "-\n"]).join(r.choice(words[: 13 + i]) for _ in range(r.randrange(60)))
        rows.append((text, r.choice(["en", "de", None]), r.choice(["s1", "s2", "S2", "", None, "é"])))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    rows += rows[:20]  # repeated rows
    rows += [(None, "en", "s9"), ("", "fr", "s1"), ("123 _", "fr", "s2"), ("alone", "it", "s1"), ("12", None, None)]
    assert run(spark, rows) == brute(rows)


def test_small_blocks_and_a_short_list(spark, monkeypatch):
    monkeypatch.setattr(audit, "BLOCK_ROWS", 20)
    rows = corpus(3)
    assert run(spark, rows, least=2, top=4) == brute(rows, 2, 4)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_terms_of_long_texts_count_once_a_document(spark, monkeypatch):
    r = random.Random(4)
    long = " ".join("".join(r.choice("abcde") for _ in range(r.randrange(1, 4))) for _ in range(3000)) + " " + "z" * 900
    got: dict = {}
    monkeypatch.setattr(audit, "SLICE", 200)
    assert b"".join(audit._pieces(long.encode())) == long.encode()
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"lang": "en", "source": s, "text": t} for s, t in (("a", long), ("b", "abc z"), ("a", long), ("a", ""))])
    for part in audit._count_slices(iter([batch])):
        for x in part.to_pylist():
            n, docs = got.get((x["source"], x["term"]), (0, 0))
            got[x["source"], x["term"]] = (n + x["n"], docs + x["docs"])
    want = {("a", t): (2 * n, 2) for t, n in Counter(terms_of(long)).items()} | {("b", "abc"): (1, 1), ("b", "z"): (1, 1), ("a", None): (0, 0), ("b", None): (0, 0)}
    assert got == want


def test_radix_order_is_stable_and_by_all_keys():
    r = np.random.default_rng(0)
    keys = [r.integers(0, 3, size=5000).astype(np.uint64) << np.uint64(40), r.integers(0, 2**64, size=5000, dtype=np.uint64) % np.uint64(70000)]
    assert radix_order(keys).tolist() == np.lexsort((keys[1], keys[0])).tolist()
    assert radix_order([np.zeros(0, dtype=np.uint64)]).tolist() == []


def test_packed_counts_of_neighbouring_texts():
    """Texts stand side by side in the array, and terms do not run from one into the next."""
    texts = [t.encode() for t in ("ab", "ab", "", "c", "é", "", "AB x")]
    found = Counter()
    for g, term, n, docs in count_terms(texts, np.array([0, 0, 0, 0, 1, 1, 1])):
        for row in zip(g.tolist(), term.to_pylist(), n.tolist(), docs.tolist()):
            found[row] += 1
    assert set(found) == {(0, "ab", 2, 2), (0, "c", 1, 1), (1, "é", 1, 1), (1, "ab", 1, 1), (1, "x", 1, 1)}
