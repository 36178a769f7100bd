import random

from pyspark.sql import functions as F

from tidemark.llm.chat_format import DEFAULT, escape, format_conversations, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string, body string, segments string"


def rows(*turns):
    return [(c, t, r, x, "clash", "clash") for c, t, r, x in turns]


def out(spark, turns):
    df = format_conversations(spark.createDataFrame(turns, SCHEMA)).withColumn("turns", read_back(F.col("formatted")))
    return {r.conv_id: r for r in df.collect()}


def test_escape_round_trip(spark):
    r = random.Random(1)
    parts = [*DEFAULT.control, "\\", "<", "[", "/", "s>", "INST]", " ", "\n", "é", "x", "<\\s>"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(12))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    got = df.select("t", "e", unescape(F.col("e")).alias("u")).collect()
    assert all(g.t == g.u and not any(c in g.e for c in DEFAULT.control) for g in got)


def test_conversation_round_trip_and_spans(spark):
    r = random.Random(2)
    parts = [*DEFAULT.control, "\\", "<", "[", " ", "\n", "é", "x"]
    turns = []
    for c in range(60):
        for t in range(r.randrange(1, 7)):
            role = r.choice(["system", "user", "assistant", "tool", "[SEP]", "a<s>"])
            turns.append((c, t, role, "".join(r.choice(parts) for _ in range(r.randrange(8)))))
    got = out(spark, rows(*turns))
    for c in range(60):
        want = [(role, x) for i, _, role, x in turns if i == c]
        assert [(t.role, t.text) for t in got[c].turns] == want
        assert [s.role for s in got[c].segments] == [role for role, _ in want]
        escaped = [got[c].formatted[s.start : s.start + s.length] for s in got[c].segments]
        plain = spark.createDataFrame(list(enumerate(escaped)), "i int, e string").select("i", unescape(F.col("e")).alias("u"))
        if c < 3:
            assert [x.u for x in plain.orderBy("i").collect()] == [x for _, x in want]


def test_state_machine(spark):
    got = out(
        spark,
        rows(
            (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
            (2, 0, "user", "u"), (2, 1, "user", "u"),
            (3, 0, "assistant", "a"),
            (4, 0, "", "e"), (4, 1, "user", "u"),
        ),
    )
    assert {c: (r.valid, r.first_bad) for c, r in got.items()} == {1: (True, None), 2: (False, 1), 3: (False, 0), 4: (False, 0)}
    assert [s.loss for s in got[1].segments] == [False, False, True]
    assert got[1].formatted == "<<SYS>>\ns\n<</SYS>>\n\n[INST] u [/INST]<s>a</s>"


def test_nulls_ties_repeats_and_empty(spark):
    got = out(spark, rows((None, None, None, None), (None, None, "user", "x"), (5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a")))
    assert [(t.role, t.text) for t in got[None].turns] == [("", ""), ("user", "x")]
    assert [t.text for t in got[5].turns] == ["a", "a", "b"]
    assert out(spark, []) == {}


def test_very_long_text(spark):
    text = "ab </s> " * 100_000
    got = out(spark, rows((1, 0, "user", text)))
    assert got[1].turns[0].text == text
