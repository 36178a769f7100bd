"""Shared scratch locations.

Intermediate tables, stream checkpoints and audit logs go below the folder
the cluster names in ``spark.checkpoint.dir`` (a shared file system on a real
cluster). Only a single-JVM session (``local[...]``) that names none gets a
temporary folder; on a cluster that would be a different disk per machine, so
there it is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; ``ValueError`` on a cluster that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root, master = spark.sparkContext.getCheckpointDir(), spark.sparkContext.master
        except Exception:  # no SparkContext on this client (Spark Connect)
            root, master = None, ""
        if not root and not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
    if not root:
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder below the shared root for one run."""
    return f"{shared_root(spark)}/tidemark/{label}-{uuid.uuid4().hex[:12]}"
