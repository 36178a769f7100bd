"""Table sinks: full overwrite, partition replacement, append.

All writes go through Spark's file commit protocol: task output is staged and
published at job commit, and a lost executor only re-runs its tasks. For
Parquet there is no transaction log, so a multi-partition replacement is not
atomic across partitions; re-running the same write repairs any partial
result because each of these writes is a fixpoint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def writers_for(spark, rows: int) -> int:
    """Writer tasks for a table of that many one-row partitions: one each, at most one wave."""
    return max(1, min(rows, int(spark.sparkContext.defaultParallelism)))


def _layout(
    df: DataFrame,
    partition_cols: Sequence[str],
    files_per_partition: int | None,
    writers: int | None = None,
    rebalance: bool = False,
) -> DataFrame:
    """How rows reach the writer tasks; by default as they are (no shuffle).

    * ``rebalance``: Spark's ``REBALANCE`` hint on the partition keys. AQE
      sizes writer tasks to the advisory partition size, merging small
      partitions and splitting a hot one (say a third of all rows) across
      tasks, so files come out near the advisory size.
    * ``files_per_partition=N``: hash on the partition keys plus a salt in
      ``[0, N)`` from a hash of the whole row and of the input task's
      partition id. A hot partition is written by N tasks, and so is a hot
      group of identical copies, which a row hash alone would send to one
      task. The salt is deterministic per task, so a retried task rebuilds
      exactly the rows it had.
    * ``writers=W``: exactly W writer tasks (AQE does not merge them), for
      small outputs spread over many partitions, such as one row per week;
      otherwise AQE would merge them into one task writing every file in turn.

    Without any option the input partitioning is kept; Spark sorts each
    task's rows by the partition keys before writing.
    """
    if rebalance:
        return df.hint("rebalance", *partition_cols)
    keys = [F.col(c) for c in partition_cols]
    if files_per_partition:
        row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
        keys.append(F.pmod(row_hash, F.lit(int(files_per_partition))))
    if writers:
        # On a hash expression of the keys: a plain ``repartition(W, keys)``
        # over an aggregate already hash-partitioned on the same keys is
        # dropped as redundant, and AQE then merges that shuffle into a
        # single writer task.
        return df.repartition(int(writers), F.xxhash64(*keys))
    if files_per_partition:
        return df.repartition(*keys)
    return df


def same_path(path: str) -> str:
    """Comparable form of a path: ``file:///a/b``, ``file:/a/b`` and ``/a/b`` agree."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return path.rstrip("/")


def _nested(a: str, b: str) -> bool:
    a, b = same_path(a) + "/", same_path(b) + "/"
    return a.startswith(b) or b.startswith(a)


def scan_roots(df: DataFrame) -> list[str]:
    """Root paths of the file scans in the plan of ``df`` (one or a few per scan, whatever the files)."""
    roots, leaves = [], df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            found = leaf.relation().location().rootPaths()
            roots += [found.apply(k).toString() for k in range(found.size())]
    return roots


def _reads_path(df: DataFrame, path: str, reads_from: Sequence[str] | None = None) -> bool:
    """Does ``df`` read files below ``path``, or above it? By the roots of its scans, or ``reads_from``."""
    return any(_nested(r, path) for r in (scan_roots(df) if reads_from is None else reads_from))


def _write(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    *,
    mode: str,
    overwrite_mode: str | None,
    fmt: str,
    files_per_partition: int | None,
    options: Mapping[str, Any] | None,
    writers: int | None = None,
    rebalance: bool = False,
    manifest: bool = False,
) -> dict[str, Any]:
    """Write ``df``; returns what the write pass itself counted: the rows and, if asked for, the keys of the partitions."""
    obs = Observation()
    laid_out = _layout(df, partition_cols, files_per_partition, writers, rebalance)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if manifest and partition_cols:
        metrics.append(F.collect_set(F.struct(*partition_cols)).alias("partitions"))
    counted = laid_out.observe(obs, *metrics)
    writer = counted.write.format(fmt).mode(mode)
    if overwrite_mode:
        writer = writer.option("partitionOverwriteMode", overwrite_mode)
    if options:
        writer = writer.options(**{k: str(v) for k, v in options.items()})
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(path)
    try:
        found = obs.get
        rows, keys = int(found["rows"]), found.get("partitions", [])
    except Exception:
        # AQE replaces an input that turns out empty, and the count with it.
        # Any other reason for a missing count is an error.
        if not df.isEmpty():
            raise
        rows, keys = 0, []
    if not manifest:
        return {"rows": rows}
    # An empty string is stored as the null partition.
    return {"rows": rows, "partitions": sorted({tuple(None if v == "" else v for v in k) for k in keys}, key=repr)}


def overwrite_all(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    *,
    fmt: str = "parquet",
    files_per_partition: int | None = None,
    options: Mapping[str, Any] | None = None,
    reads_from: Sequence[str] | None = None,
    writers: int | None = None,
    rebalance: bool = False,
    manifest: bool = False,
) -> dict[str, Any]:
    """Replace every partition and the schema of the table at ``path``.

    Partitions absent from ``df`` disappear. Refuses to overwrite a path
    that ``df`` itself reads: Spark would delete the input before reading it.
    ``reads_from`` names the roots ``df`` was read from, which makes that
    check a path comparison. Returns ``{"rows": rows written}``, counted in
    the write pass itself; with ``manifest`` also ``partitions``, the key tuples
    of the partitions written, taken from the same pass (one value per partition
    and task).
    """
    if _reads_path(df, path, reads_from):
        raise ValueError(f"Refusing to overwrite {path}: the DataFrame reads from it.")
    return _write(
        df, path, partition_cols, mode="overwrite", overwrite_mode="static",
        fmt=fmt, files_per_partition=files_per_partition, options=options,
        writers=writers, rebalance=rebalance, manifest=manifest,
    )


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    *,
    fmt: str = "parquet",
    files_per_partition: int | None = None,
    options: Mapping[str, Any] | None = None,
    writers: int | None = None,
    rebalance: bool = False,
    manifest: bool = False,
) -> dict[str, Any]:
    """Replace exactly the partitions present in ``df``; keep all others.

    The idempotent write: running it twice leaves the table as running it
    once, an empty ``df`` changes nothing, and a partition that vanished from
    the source stays in the table. The overwrite mode is set on this write
    only, never on the session. ``files_per_partition``, ``writers`` and
    ``rebalance`` choose the file layout (see ``_layout``); ``manifest`` adds
    the key tuples of the partitions written to the result.
    """
    if not partition_cols:
        raise ValueError("replace_partitions needs partition columns.")
    return _write(
        df, path, partition_cols, mode="overwrite", overwrite_mode="dynamic",
        fmt=fmt, files_per_partition=files_per_partition, options=options,
        writers=writers, rebalance=rebalance, manifest=manifest,
    )


def append_table(
    df: DataFrame,
    table: str,
    path: str | None = None,
    *,
    fmt: str = "parquet",
    partition_cols: Sequence[str] = (),
) -> None:
    """Append to a catalog table, external at ``path`` when given.

    Deliberately not idempotent: every run adds its rows again.
    """
    writer = df.write.mode("append").format(fmt)
    if path:
        writer = writer.option("path", path)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.saveAsTable(table)


def preview(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """Print the first ``n`` rows on the driver."""
    df.show(n, truncate=truncate)


def write_sink(df: DataFrame, sink: Mapping[str, Any], mode: str = "replace") -> dict[str, Any]:
    """Write ``df`` to a described sink: ``replace`` (dynamic), ``overwrite`` or ``append``.

    A description has ``location`` and may have ``format``, ``partitions``,
    ``options`` and ``metadata``.
    """
    if unknown := set(sink) - {"name", "location", "format", "partitions", "options", "metadata"}:
        raise ValueError(f"A sink description has no {sorted(unknown)}.")
    place, keys = sink["location"], list(sink.get("partitions", ()))
    how = {"fmt": sink.get("format", "parquet"), "options": sink.get("options")}
    if mode == "replace":
        return replace_partitions(df, place, keys, **how)
    if mode == "overwrite":
        return overwrite_all(df, place, keys, **how)
    if mode == "append":
        return _write(df, place, keys, mode="append", overwrite_mode=None, files_per_partition=None, **how)
    raise ValueError(f"Unknown sink mode {mode!r}; expected replace, overwrite or append.")
