import random

from tidemark.functions.predicates import cherry_pick
from tidemark.operators.select import keep_requested


def test_keep_requested_equals_cherry_pick(spark):
    rnd = random.Random(7)
    vals = [None, "a", "b", "c", "d"]
    data = [(rnd.choice(vals), rnd.choice(vals), i) for i in range(500)]
    req = [(rnd.choice(vals[1:]), rnd.choice(vals)) for _ in range(6)]  # a request value may be NULL
    df = spark.createDataFrame(data, "k0 STRING, k1 STRING, v INT")
    req_df = spark.createDataFrame(req, "k0 STRING, k1 STRING")
    joined = sorted(r.v for r in keep_requested(df, req_df, ["k0", "k1"]).collect())
    pred = cherry_pick([{"k0": a, "k1": b} for a, b in req])
    picked = sorted(r.v for r in df.where(pred).collect())
    assert joined == picked and joined


def test_keep_requested_empty_request(spark):
    df = spark.createDataFrame([(None,), ("a",)], "k STRING")
    assert keep_requested(df, spark.createDataFrame([], "k STRING"), ["k"]).count() == 0


def test_select_partitions_routes_agree(spark):
    from tidemark.operators.select import requests_frame, select_partitions

    rnd = random.Random(3)
    vals = [None, "a", "b", "c"]
    df = spark.createDataFrame([(rnd.choice(vals), rnd.choice(vals), i) for i in range(300)], "k0 STRING, k1 STRING, v INT")
    req = [{"k0": a, "k1": b} for a in "abc" for b in "ab"]
    lit_rows = sorted(r.v for r in select_partitions(df, req).collect())
    frame_rows = sorted(r.v for r in select_partitions(df, requests_frame(spark, req)).collect())
    assert lit_rows == frame_rows and lit_rows


def test_both_routes_cast_requested_values(spark):
    from tidemark.operators.select import requests_frame, select_partitions

    df = spark.createDataFrame([(7, "a"), (8, "b"), (None, "c")], "k INT, v STRING")
    req = {"k": ["7", "9"]}
    picked = sorted(r.v for r in select_partitions(df, req).collect())
    assert picked == sorted(r.v for r in select_partitions(df, requests_frame(spark, req)).collect()) == ["a", "c"]
