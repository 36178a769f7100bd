import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.secret_ledger import RULES, SLICE_BYTES, Rule, find_secrets, redact, rules_version, scan_text, scan_unseen

SCHEMA = "doc_id long, text string, _blob string, version string"


def spans(rows):
    return [(r["kind"], r["start"], r["end"]) for r in rows]


def test_rules_follow_the_base_definitions():
    hexa = "0123456789abcdef01234567"
    assert spans(scan_text(f"ä PassWord: '{hexa}'")) == [("assign", 2, 37), ("hex", 13, 37)]
    assert scan_text("token=abc") == []  # under six characters
    # a dropped match still uses up its characters
    assert scan_text("secret: token =abcdefgh") == []
    assert spans(scan_text("AKIA" + "A" * 16)) == [("access", 0, 20)]
    assert scan_text("AKIA" + "A" * 15) == [] and scan_text("f" * 23) == []
    assert scan_text("paſſword=abcdefg") == []  # only A-Z and a-z match in either case


def test_ledger_scans_each_blob_once_per_version(spark, scratch):
    ledger = scratch("ledger")
    docs = spark.createDataFrame(
        [(1, "token=abcdef1", "x", "y"), (2, "token=abcdef1", None, None), (2, None, None, None), (None, "", None, None)], SCHEMA
    )
    assert scan_unseen(docs, ledger).count() == 2  # the secret, and the empty text of the null too
    assert scan_unseen(docs, ledger).count() == 0
    more = docs.unionByName(spark.createDataFrame([(3, "AKIA" + "B" * 16, None, None)], SCHEMA))
    assert scan_unseen(more, ledger).count() == 1
    # Other rules are another version by themselves: what an added rule finds is there, and the first findings stay.
    added = (*RULES, Rule("clean", re.compile("AKIAB+")))
    assert scan_unseen(more, ledger, added).count() == 3
    assert {s.kind for r in find_secrets(more, ledger, added).collect() for s in r.findings} == {"assign", "access", "clean"}
    assert scan_unseen(more, ledger, added).count() == scan_unseen(more, ledger).count() == 0
    found = {(r.doc_id, tuple(spans(r.findings))) for r in find_secrets(more, ledger).collect()}
    assert found == {(1, (("assign", 0, 13),)), (2, (("assign", 0, 13),)), (2, ()), (None, ()), (3, (("access", 0, 20),))}


def test_the_version_is_a_digest_of_the_rules():
    base = Rule("k", re.compile("a+"))
    others = [Rule("l", re.compile("a+")), Rule("k", re.compile("a*")), Rule("k", re.compile("a+", re.I)), Rule("k", re.compile("a+"), least=2)]
    others += [Rule("k", re.compile("(a)+"), group=1), Rule("k", re.compile("a+"), hints=("a",))]
    assert len({rules_version((r,)) for r in [base, *others]} | {rules_version((base, others[0])), rules_version((others[0], base))}) == 9
    assert rules_version((base,)) == rules_version((Rule("k", re.compile("a+")),))


def test_a_blob_that_two_scans_added_counts_once(spark, scratch):
    one, two = scratch("ledger"), scratch("ledger")
    docs = spark.createDataFrame([(1, "token=abcdef1", "x", "y"), (2, "token=abcdef1", None, None), (3, "clean", None, None)], SCHEMA)
    for ledger in (one, two):
        scan_unseen(docs, ledger)
    version = f"version={rules_version()}"
    spark.read.parquet(f"{two}/{version}").write.mode("append").parquet(f"{one}/{version}")
    assert spark.read.parquet(f"{one}/{version}").count() == 4
    assert sorted((r.doc_id, len(r.findings)) for r in find_secrets(docs, one).collect()) == [(1, 1), (2, 1), (3, 0)]
    assert sorted(r.text for r in redact(docs, one).collect()) == ["[REDACTED]", "[REDACTED]", "clean"]


def test_small_increment_goes_through_the_broadcast_filter(spark, scratch):
    ledger = scratch("ledger")
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("token=abcdef"), "id").alias("text"))
    scan_unseen(docs.where("doc_id < 40"), ledger)
    assert scan_unseen(docs, ledger).count() == 10
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert all(len(r.findings) == 1 for r in find_secrets(docs, scratch("ledger")).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_redact_keeps_columns_and_masks_overlapping_spans(spark, scratch):
    hexa = "0123456789abcdef01234567"
    docs = spark.createDataFrame([(1, f"a token={hexa} z", "b", "c"), (2, "clean", None, None), (3, None, None, None)], SCHEMA)
    out = redact(docs, scratch("ledger"))
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a [REDACTED] z", 2: "clean", 3: None}


NEW_LINES = ("\n", "\r\n", "\\n", " ", "\n    ", "\n> ")


def test_redact_leaves_nothing_of_a_private_key(spark, scratch):
    import base64
    import random

    r = random.Random(3)
    docs = []
    for nl in NEW_LINES:
        for head in ([], ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0011AABB", ""]):
            for size in (48, 57, 1190, 1192):  # of one line; with a last line of 4; padded
                code = base64.b64encode(r.randbytes(size)).decode()
                lines = [code[i : i + 64] for i in range(0, len(code), 64)]
                begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
                key = nl.join([begin, *head, *lines])
                docs += [(f"Before {key}{nl}{end} after it", lines, "Before [REDACTED] after it")]
                docs += [(f"Before {key}", lines, "Before [REDACTED]"), (f"Before {key[:-7]}", lines, "Before [REDACTED]")]
                docs += [(f"{key}{nl}{end}\nwords between\n{key}{nl}{end}", lines, "[REDACTED]\nwords between\n[REDACTED]")]
                if nl != " ":
                    docs += [(f"{key}\n\nNo end, but words.\n{key}{nl}{end}", lines, "[REDACTED]\n\nNo end, but words.\n[REDACTED]")]
    table = spark.createDataFrame([(i, t, None, None) for i, (t, _, _) in enumerate(docs)], SCHEMA)
    got = {x.doc_id: x.text for x in redact(table, scratch("ledger")).collect()}
    for i, (text, lines, want) in enumerate(docs):
        assert got[i] == want, text
        assert not any(line[:8] in got[i] for line in lines)


def test_private_key_span_takes_no_words_and_linear_time():
    begin = "-----BEGIN PRIVATE KEY-----"
    assert spans(scan_text(f"a {begin} in a sentence.")) == [("private_key", 2, 29)]
    for text in (f"{begin}\n{'a' * 50}\n" * 5000, begin + "+" * 500_000, begin + "\n" * 500_000, begin + "a " * 250_000):
        assert len(scan_text(text)) >= 1


def test_empty_table_and_long_text(spark, scratch):
    assert find_secrets(spark.createDataFrame([], SCHEMA), scratch("ledger")).count() == 0
    long = spark.createDataFrame([(1, "word " * 400_000 + "secret=abcdefgh", None, None)], SCHEMA)
    assert len(find_secrets(long, scratch("ledger")).first().findings) == 1


@pytest.mark.parametrize("seed", range(5))
def test_query_against_brute_force(spark, seed):
    import random

    r = random.Random(seed)
    parts = ["token", "=", ":", " ", '"', "AKIA", "ABCD1234", "deadbeef", "secret", "API_KEY", "é", "_", "xyzzyx", "\n"]
    text = "".join(r.choice(parts) for _ in range(3000))
    brute = []
    for k, rule in enumerate(RULES):
        at = 0
        while m := rule.pattern.search(text, at):  # leftmost, not overlapping
            if len(m[rule.group]) >= rule.least:
                brute.append((m.start(), k, m.end()))
            at = m.end()
    assert spans(scan_text(text)) == [(RULES[k].kind, a, b) for a, k, b in sorted(brute)]


def test_custom_rule():
    rule = Rule("pin", re.compile(r"pin=(\d+)"), group=1, least=4)
    assert spans(scan_text("pin=12 pin=1234", (rule,))) == [("pin", 7, 15)]


def test_redact_takes_texts_of_any_length_among_others(spark, scratch):
    """Slices are cut by bytes: a text beyond a slice's size is scanned and masked whole, its neighbours as they are."""
    long = "ä b " * (SLICE_BYTES // 4) + "token=abcdef1 end"
    texts = ["", None, "plain", long, "secret: abcdefg!", "plain", "x" * SLICE_BYTES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.text for r in redact(docs, scratch("ledger")).collect()}
    want = {**dict(enumerate(texts)), 3: long.replace("token=abcdef1", "[REDACTED]"), 4: "[REDACTED]!"}
    assert got == want
