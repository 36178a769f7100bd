import random
import re

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from tidemark.llm.secret_ledger import scan_text
from tidemark.llm.source_mixing import token_targets

#: Clashing names beside the columns of documents.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, `row.x` string, class_id string, copies string"
VOCABULARY = {"aa": "abba cab bacca dada gabba".split(), "zz": "xyz zyx wyv yzzy vyxx".split()}


def documents(r):
    out = []

    def add(text, lang=None, doc_id=-1):
        out.append((len(out) if doc_id == -1 else doc_id, text, lang, r.choice(["s", "t", None]), None if text is None else len(text), "k", "r", "c", "m"))

    bases = []
    for i in range(60):
        lang = r.choice(list(VOCABULARY))
        words = [r.choice(VOCABULARY[lang]) + str(r.choice(["", "", "a", "x"])) + (f"q{r.randrange(99)}" if r.random() < 0.5 else "") for _ in range(r.randrange(30, 120))]
        bases.append((words, lang))
        add(" ".join(words), lang)
    for words, lang in bases[:12]:  # exact and near copies
        add(" ".join(words), lang)
        add(" ".join(words[:-1] + ["edit"]), lang)
    add(out[3][1], "aa", doc_id=3)  # a repeated row, and an id with two texts
    add(out[4][1] + " and more of it", "aa", doc_id=3)
    add(" ".join(bases[20][0] + ["token=abcdef0123456789"]), "aa", doc_id=None)
    for text in (None, "", " \n", "12 34", "!!"):
        add(text)
    add("abba cab " + " ".join(f"item{k}" for k in range(12)) + " dada", "aa")
    add("password: hunter2222 " + " ".join(r.choice(VOCABULARY["aa"]) for _ in range(40)), "aa")
    add("cab", "aa")
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(documents(random.Random(11)), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"Item{k}," for k in range(12))), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def shingle_set(text):
    w = text.lower().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(cp.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "decontamination", "secrets", "mixing"]

    one = cp.materialize(stages["language_id"](spark, docs, folder), "t")
    assert one.columns == docs.columns
    assert rows_of(one) == [r for r in rows_of(docs) if r[1] and re.search("[a-z]", r[1])]

    two = cp.materialize(stages["near_duplicates"](spark, one, folder), "t")
    rows = rows_of(one)
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    kept = rows_of(two)
    assert set(kept) <= set(rows) and len(kept) == len({root(i) for i in range(len(rows))})
    assert {root(rows.index(r)) for r in kept} == {root(i) for i in range(len(rows))}
    assert two.columns == docs.columns

    three = cp.materialize(stages["decontamination"](spark, two, folder), "t")
    item = " ".join(f"item{k}" for k in range(12))
    assert rows_of(three) == [r for r in kept if item not in r[1]] and len(kept) - three.count() == 1

    four = cp.materialize(stages["secrets"](spark, three, folder), "t")
    assert four.columns == docs.columns and four.count() == three.count()
    before, after = {(r[0], r[3]): r for r in rows_of(three)}, rows_of(four)
    for r in after:
        assert not scan_text(r[1]) and r[4] == len(r[1])
    assert sum("[REDACTED]" in r[1] for r in after) == sum(bool(scan_text(r[1])) for r in before.values()) >= 1

    five = cp.materialize(stages["mixing"](spark, four, folder), "t")
    assert five.columns == [c for c in docs.columns if c != "copies"] + ["copies"]
    sizes, taken = {}, {}
    for r in after:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    mixed = five.collect()
    for r in mixed:
        assert r["copies"] in (1, 2)
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * len(r["text"].split())
    target = token_targets(sizes, (3, 1, 2), 1.5)
    longest = max(len(r[1].split()) for r in after)
    assert all(abs(taken.get(s, 0) - target[s]) <= longest for s in sizes)


def test_texts_of_no_learned_language_go(spark, folder):
    r = random.Random(5)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    junk = [" ".join("".join(r.choice("asdfghjklqwertuiop") for _ in range(r.randrange(3, 12))) for _ in range(n)) for n in (3, 40, 2000)]
    foreign = ["Русский язык является одним из восточнославянских", "漢字日本語の文章です", "ж", "the quick brown fox jumped over lazy dogs"]
    texts = foreign + junk + ["cab", "abba dada cab 17", "XYZ, zyx!"]
    more = spark.createDataFrame([(10_000 + i, t, None) for i, t in enumerate(texts)], docs.schema)
    kept = {x.doc_id for x in cp.identify_language(spark, docs.unionByName(more), folder).collect()}
    assert {x for x in kept if x is not None and x >= 10_000} == {10_007, 10_008, 10_009}
    assert len([x for x in kept if x is None or x < 10_000]) == docs.where("text rlike '[a-z]'").select("doc_id").distinct().count()


def test_run_is_its_stages_and_reruns_agree(spark, folder):
    assert rows_of(cp.run(spark, folder)) == rows_of(cp.run(spark, folder))


def test_every_stage_takes_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0


def test_rows_alike_in_every_column(spark, folder):
    docs = spark.createDataFrame([(1, "abba cab dada", "aa", "s", 13)] * 3 + [(2, None, None, None, None)] * 2, "doc_id long, text string, lang string, source string, n_chars long")
    assert cp.drop_near_duplicates(spark, docs, folder).count() == 3  # one text, and two rows without words
    assert cp.drop_contaminated(spark, docs, folder).count() == 5
    assert sum(r.copies for r in cp.mix(spark, docs, folder).collect()) in (4, 5)
    assert docs.where(F.col("text").isNull()).count() == 2
