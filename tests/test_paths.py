from types import SimpleNamespace

import pytest

from tidemark.paths import fresh_dir, shared_root


def session(master, named=None, checkpoint=None):
    conf = {} if named is None else {"spark.checkpoint.dir": named}
    return SimpleNamespace(
        conf=SimpleNamespace(get=conf.get, set=conf.__setitem__),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint),
    )


def test_named_folder_counts():
    assert shared_root(session("spark://h:7077", named="hdfs://x/ckpt/")) == "hdfs://x/ckpt"
    assert shared_root(session("yarn", checkpoint="hdfs://x/ckpt/1")) == "hdfs://x/ckpt/1"
    assert fresh_dir(session("yarn", named="/a"), "t").startswith("/a/tidemark/t-")


def test_only_a_single_jvm_gets_a_temporary_folder():
    for master in ("spark://h:7077", "yarn", "local-cluster[3,2,1024]", "k8s://h"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(session(master))
    local = session("local[8]")
    assert shared_root(local) == shared_root(local)
