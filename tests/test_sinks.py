import os

import pytest
from pyspark.sql import functions as F

from helpers import plan_text
from tidemark.operators.sinks import overwrite_all, replace_partitions, write_sink


def _table(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect())


def _files(path):
    out = {}
    for root, _, names in os.walk(path.removeprefix("file:")):
        for n in names:
            if n.endswith(".parquet"):
                p = os.path.join(root, n)
                out[p] = os.stat(p).st_mtime_ns
    return out


def test_replace_is_fixpoint_and_keeps_others(spark, scratch):
    path = scratch("k2")
    base = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k STRING, v INT")
    replace_partitions(base, path, ["k"])
    new = spark.createDataFrame([("b", 20), ("b", 21)], "k STRING, v INT")
    replace_partitions(new, path, ["k"])
    once = _table(spark, path)
    untouched = {p: m for p, m in _files(path).items() if "k=b" not in p}
    replace_partitions(new, path, ["k"])
    assert _table(spark, path) == once == [("a", 1), ("b", 20), ("b", 21), ("c", 3)]
    after = {p: m for p, m in _files(path).items() if "k=b" not in p}
    assert after == untouched  # untouched partitions: same files, not rewritten


def test_replace_empty_is_noop(spark, scratch):
    path = scratch("k2e")
    replace_partitions(spark.createDataFrame([("a", 1)], "k STRING, v INT"), path, ["k"])
    metrics = replace_partitions(spark.createDataFrame([], "k STRING, v INT"), path, ["k"])
    assert metrics == {"rows": 0}
    assert _table(spark, path) == [("a", 1)]


def test_disjoint_picks_in_any_order_equal_joint_run(spark, scratch):
    base = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k STRING, v INT")
    p1 = spark.createDataFrame([("a", 10)], "k STRING, v INT")
    p2 = spark.createDataFrame([("c", 30)], "k STRING, v INT")
    results = []
    for order in ([p1, p2], [p2, p1], [p1.unionByName(p2)]):
        path = scratch("k2o")
        replace_partitions(base, path, ["k"])
        for part in order:
            replace_partitions(part, path, ["k"])
        results.append(_table(spark, path))
    assert results[0] == results[1] == results[2] == [("a", 10), ("b", 2), ("c", 30)]


def test_stale_partition_stays_with_replace_but_not_overwrite(spark, scratch):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    new = spark.createDataFrame([("a", 5)], "k STRING, v INT")
    p_dyn, p_static = scratch("dyn"), scratch("static")
    replace_partitions(base, p_dyn, ["k"])
    replace_partitions(new, p_dyn, ["k"])
    overwrite_all(base, p_static, ["k"])
    overwrite_all(new, p_static, ["k"])
    assert _table(spark, p_dyn) == [("a", 5), ("b", 2)]
    assert _table(spark, p_static) == [("a", 5)]


def test_overwrite_replaces_schema(spark, scratch):
    path = scratch("schema")
    overwrite_all(spark.createDataFrame([("a", 1)], "k STRING, v INT"), path, ["k"])
    overwrite_all(spark.createDataFrame([("a", 1, "x")], "k STRING, v INT, w STRING"), path, ["k"])
    assert set(spark.read.parquet(path).columns) == {"k", "v", "w"}


def test_overwrite_refuses_own_input(spark, scratch):
    path = scratch("self")
    overwrite_all(spark.createDataFrame([("a", 1)], "k STRING, v INT"), path, ["k"])
    with pytest.raises(ValueError, match="Refusing to overwrite"):
        overwrite_all(spark.read.parquet(path), path, ["k"])
    assert _table(spark, path) == [("a", 1)]


def test_files_per_partition_spreads_hot_partition(spark, scratch):
    path = scratch("spread")
    df = spark.range(20000).select(F.when(F.col("id") < 15000, "hot").otherwise("cold").alias("k"), F.col("id").alias("v"))
    # AQE would merge these tiny shuffle partitions; at scale it merges only small ones.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        replace_partitions(df, path, ["k"], files_per_partition=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [p for p in _files(path) if "k=hot" in p]
    assert 1 < len(hot) <= 4
    assert spark.read.parquet(path).count() == 20000



def test_files_per_partition_spreads_identical_copies(spark, scratch):
    path = scratch("copies")
    # 12000 identical rows over 6 input partitions: one row hash, six task ids.
    df = spark.range(0, 12000, 1, 6).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        replace_partitions(df, path, ["k"], files_per_partition=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 1 < len(_files(path)) <= 4
    assert spark.read.parquet(path).count() == 12000


def test_write_sink_modes(spark, scratch):
    spec = {"name": "t", "location": scratch("sink"), "partitions": ("k",)}
    df = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    write_sink(df, spec, "overwrite")
    write_sink(df, spec, "append")
    assert spark.read.parquet(spec["location"]).count() == 2
    write_sink(df, spec, "replace")
    assert spark.read.parquet(spec["location"]).count() == 1
    with pytest.raises(ValueError):
        write_sink(df, spec, "merge")
    with pytest.raises(ValueError, match="has no"):
        write_sink(df, {"location": "x", "path": "y"})


def test_overwrite_guard_by_declared_roots(spark, scratch):
    path = scratch("roots")
    df = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    with pytest.raises(ValueError, match="Refusing"):
        overwrite_all(df, path, ["k"], reads_from=[path + "/"])
    overwrite_all(df, path, ["k"], reads_from=[scratch("elsewhere")])
    assert _table(spark, path) == [("a", 1)]


def test_rows_are_counted_and_a_missing_count_raises(spark, scratch, monkeypatch):
    from tidemark.operators import sinks

    df = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), (None, 3, 2), ("a", 4, 2)], "k STRING, v INT, j INT")
    assert replace_partitions(df, scratch("rep"), ["k", "j"]) == {"rows": 4}

    class Broken(sinks.Observation):
        @property
        def get(self):
            raise RuntimeError("no metrics")

    monkeypatch.setattr(sinks, "Observation", Broken)
    with pytest.raises(RuntimeError, match="no metrics"):
        replace_partitions(df, scratch("rep"), ["k", "j"])


def test_scan_roots_do_not_list_files(spark, scratch):
    from tidemark.operators.sinks import same_path, scan_roots

    path = scratch("many")
    replace_partitions(spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("v")), path, ["k"])
    df = spark.read.parquet(path)
    assert [same_path(r) for r in scan_roots(df.join(df.groupBy("v").count(), "v"))] == [same_path(path)] * 2
    assert scan_roots(spark.range(3)) == []


def test_rebalance_and_writers_layouts(spark, scratch):
    df = spark.range(3000).select((F.col("id") % 30).cast("string").alias("k"), F.col("id").alias("v"))
    for kw in ({"rebalance": True}, {"writers": 4}, {"writers": 4, "files_per_partition": 2}):
        path = scratch("layout")
        m = replace_partitions(df, path, ["k"], **kw)
        assert m["rows"] == 3000
        assert spark.read.parquet(path).count() == 3000
    plan = plan_text(df.hint("rebalance", "k"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    # writers=W survives over an aggregate already partitioned on the key.
    from tidemark.operators.sinks import _layout

    agg = df.groupBy("k").count()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "xxhash64(k#" in plan_text(_layout(agg, ["k"], None, writers=n))
