import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from helpers import plan_text
from tidemark.functions.predicates import (
    cherry_pick,
    choose_predicate,
    everything,
    latest,
    strategy,
)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# The reference's own cases, asserted on the rows the predicate keeps.
@pytest.mark.parametrize("as_column", [False, True])
def test_latest_one_key(spark, as_column):
    key = F.col("scenario") if as_column else "scenario"
    target = spark.createDataFrame([(0, 1), (1, 2), (1, 3)], "scenario INT, value INT")
    source = spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "scenario INT")
    got = _rows(source.where(latest(target, [key])))
    assert got == sorted([(2,), (3,), (None,)], key=repr)


@pytest.mark.parametrize("as_column", [False, True])
def test_latest_two_keys_conjunctive(spark, as_column):
    keys = [F.col("scenario"), F.col("day")] if as_column else ["scenario", "day"]
    target = spark.createDataFrame([(0, 0, 1), (1, 1, 2), (1, 2, 3), (1, 2, 4)], "scenario INT, day INT, value INT")
    source = spark.createDataFrame(
        [(2, 3), (2, 2), (1, 3), (2, None), (None, 1), (None, None), (3, 1)], "scenario INT, day INT"
    )
    got = set(tuple(r) for r in source.where(latest(target, keys)).collect())
    # (scenario IS NULL OR scenario > 1) AND (day IS NULL OR day > 2)
    assert got == {(2, 3), (2, None), (None, None)}


def test_latest_tuple_order(spark):
    target = spark.createDataFrame([(2025, 1)], "y INT, w INT")
    source = spark.createDataFrame([(2025, 2), (2025, 1), (2024, 9), (2026, 0), (None, 0), (None, 5)], "y INT, w INT")
    conj = set(tuple(r) for r in source.where(latest(target, ["y", "w"])).collect())
    lexi = set(tuple(r) for r in source.where(latest(target, ["y", "w"], tuple_order=True)).collect())
    assert conj == {(None, 5)}  # (2025, 2) is rejected: 2025 > 2025 is false
    assert lexi == {(2025, 2), (2026, 0), (None, 0), (None, 5)}


def test_latest_empty_raises(spark):
    empty = spark.createDataFrame([], "scenario INT")
    with pytest.raises(ValueError, match="Cannot find the latest partition."):
        latest(empty, ["scenario"])


def test_latest_all_null_target_keeps_only_null_keys(spark):
    target = spark.createDataFrame([(None,)], "k INT")
    source = spark.createDataFrame([(1,), (None,)], "k INT")
    assert _rows(source.where(latest(target, ["k"]))) == [(None,)]


def test_trivial_and_strategy_by_name(spark):
    df = spark.range(5)
    assert df.where(everything()).count() == 5
    assert df.where(strategy("TRIVIAL")).count() == 5
    assert df.where(strategy(" Cherry_Pick ", {"id": [1, 3]})).count() == 2
    with pytest.raises(ValueError, match="Unknown partition strategy"):
        strategy("newest")


def test_cherry_pick_empty_is_false(spark):
    assert spark.range(3).where(cherry_pick({"id": []})).count() == 0
    assert spark.range(3).where(cherry_pick([])).count() == 0


def test_cherry_pick_multicolumn_dict_rejected():
    with pytest.raises(ValueError, match="one key column"):
        cherry_pick({"a": [1], "b": [2]})


def test_cherry_pick_casts_to_column_type(spark):
    df = spark.createDataFrame([(7,), (8,)], "k INT")
    assert _rows(df.where(cherry_pick({"k": ["7"]}, schema={"k": IntegerType()}))) == [(7,)]
    assert _rows(df.where(cherry_pick({"k": ["7"]}, schema=df.schema))) == [(7,)]


def _brute(rows, names, tuples):
    def ok(row):
        return any(all(row[n] is None or row[n] == t[i] for i, n in enumerate(names)) for t in tuples)

    return sorted((tuple(r[n] for n in names) for r in rows if ok(r)), key=repr)


@pytest.mark.parametrize("n_keys,n_req", [(1, 3), (1, 40), (2, 4), (2, 60), (3, 5), (3, 80)])
def test_cherry_pick_matches_brute_force(spark, n_keys, n_req):
    rnd = random.Random(n_keys * 1000 + n_req)
    names = [f"k{i}" for i in range(n_keys)]
    vals = [None, "a", "b", "c", "d", "e", "f", "g"]
    data = [{n: rnd.choice(vals) for n in names} for _ in range(400)]
    pool = list(itertools.product(*[vals[1:] for _ in names]))
    req = rnd.sample(pool, min(n_req, len(pool)))
    df = spark.createDataFrame([tuple(d[n] for n in names) for d in data], ", ".join(f"{n} STRING" for n in names))
    pred = cherry_pick([dict(zip(names, t)) for t in req])
    got = sorted((tuple(r) for r in df.where(pred).collect()), key=repr)
    assert got == _brute(data, names, req)
    # Large requests use hash-set membership; plan size does not grow with them.
    plan = plan_text(df.where(pred))
    assert ("INSET" in plan.upper()) == (len(req) > 10)  # Spark turns longer lists into sets


def test_choose_predicate_modes(spark):
    target = spark.createDataFrame([("2024_03", 1)], "year_woy STRING, n INT")
    assert choose_predicate(target, ["year_woy"], backfill=True)[0] == "trivial"
    assert choose_predicate(target, ["year_woy"], partitions={"year_woy": ["x"]})[0] == "cherry_pick"
    assert choose_predicate(target, ["year_woy"], partitions={})[0] == "latest"
    assert choose_predicate(target, ["year_woy"], partitions=None)[0] == "latest"
