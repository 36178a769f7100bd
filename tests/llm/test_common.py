"""Helpers of the training-data operators."""

import glob

import pytest

from tidemark.llm import common
from tidemark.llm.components import connected_components


@pytest.fixture()
def wide(spark):
    """A wide shuffle whose partitions Spark does not coalesce."""
    held = {"spark.sql.shuffle.partitions": "101", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def files(df):
    return len(df.inputFiles())


def test_a_small_table_is_written_by_few_tasks(wide):
    tasks = 2 * wide.sparkContext.defaultParallelism
    grouped = wide.range(5000).selectExpr("id * 7 as id").groupBy("id").count()
    assert files(common.materialize(grouped, "t")) > tasks  # one for each shuffle partition
    small = common.materialize(grouped, "t", 1000)
    assert files(small) <= tasks
    assert small.count() == 5000 and small.where("count != 1").isEmpty()


def test_a_large_table_keeps_the_width_of_the_shuffle(wide):
    grouped = wide.range(5000).selectExpr("id * 7 as id").groupBy("id").count()
    assert files(common.materialize(grouped, "t", 101 * common.TASK_BYTES)) == 101
    assert common.narrowed(grouped, 60 * common.TASK_BYTES).rdd.getNumPartitions() == max(61, 2 * wide.sparkContext.defaultParallelism)


def test_components_of_a_small_graph_are_written_by_few_tasks(wide, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "fresh_dir", lambda spark, label: str(tmp_path / f"{label}-{len(list(tmp_path.iterdir()))}"))
    edges = common.materialize(wide.range(3000).selectExpr("id as a", "id - id % 10 as b").where("a != b"), "in")
    found = connected_components(edges)
    assert {(r.node, r.component) for r in found.collect()} == {(i, i - i % 10) for i in range(3000)}
    each = [len(glob.glob(f"{p}/part-*")) for p in tmp_path.iterdir()]
    assert max(each) <= 2 * wide.sparkContext.defaultParallelism
