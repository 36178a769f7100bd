"""Full loads by pointer: a table's name is a view over the version that was published last.

A load writes a new folder and a catalog table of its own (``<name>__v...``), then
one ``CREATE OR REPLACE VIEW`` makes it the table that the name means: rows,
columns and partitions change together, in one catalog call. A load that fails
before that leaves the name as it was, and the name is never gone. Filters on
partition keys go through the view into the version's catalog listing.

Old versions stay for readers that have begun; :func:`drop_versions` removes them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sinks import overwrite_all
from tidemark.plans.tables import TableDef, create_table, ensure_schema, quoted, register_partitions, sync_partitions, table_location
from tidemark.storage import remove_folders

_PROPERTY = "tidemark.version"


def _prefix(name: str) -> str:
    return f"{name}__v"


def current_version(spark: SparkSession, schema: str, name: str) -> str | None:
    """The catalog table that ``name`` means; None if nothing was published. ``ValueError`` if the name is a table of its own."""
    if not spark.catalog.tableExists(f"{schema}.{name}"):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(schema, name)}").where(F.col("key") == _PROPERTY).collect()
    if not rows:
        raise ValueError(f"{schema}.{name} is not a published name; rename that table first.")
    return rows[0].value


def _point(spark: SparkSession, schema: str, name: str, version: str, definition: TableDef) -> None:
    """Make ``name`` mean ``version``: the one step that readers see."""
    columns = ", ".join(f"`{f.name}`" for f in definition.schema.fields)
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(schema, name)} TBLPROPERTIES ('{_PROPERTY}' = '{version}') "
        f"AS SELECT {columns} FROM {quoted(schema, version)}"
    )


def publish_version(
    spark: SparkSession,
    df: DataFrame,
    schema: str,
    name: str,
    warehouse: str,
    partition_cols: Sequence[str],
    *,
    fmt: str = "parquet",
    reads_from: Sequence[str] | None = None,
    **layout: Any,
) -> dict[str, Any]:
    """Write ``df`` as a new version below ``warehouse`` and make ``name`` mean it.

    Returns ``rows``, ``partitions`` (the manifest of the write) and ``version``.
    ``df`` may read the version that it replaces.
    """
    ensure_schema(spark, schema, f"{warehouse.rstrip('/')}/{schema}.db")
    current_version(spark, schema, name)  # a table of that name is refused before anything is written
    version = f"{_prefix(name)}{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"  # in order of time
    place = table_location(warehouse, schema, version)
    written = overwrite_all(df, place, partition_cols, fmt=fmt, reads_from=reads_from, manifest=True, **layout)
    definition = TableDef(df.schema, tuple(partition_cols))
    create_table(spark, schema, version, place, definition, fmt)
    if partition_cols:
        register_partitions(spark, quoted(schema, version), partition_cols, written["partitions"])
    _point(spark, schema, name, version, definition)
    return written | {"version": version}


def versions(spark: SparkSession, schema: str, name: str) -> list[str]:
    """All versions of ``name`` in the catalog, oldest first."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if t.name.startswith(_prefix(name)) and t.tableType != "VIEW")


def drop_versions(spark: SparkSession, schema: str, name: str, warehouse: str, keep: int = 1) -> list[str]:
    """Remove versions, with their files, but for the published one and the newest ``keep - 1`` others; returns their names."""
    current = current_version(spark, schema, name)
    others = [v for v in versions(spark, schema, name) if v != current]
    old = others[: max(0, len(others) - max(0, keep - 1))]
    for version in old:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(schema, version)}")
    remove_folders(spark, [table_location(warehouse, schema, v) for v in old])
    return old


def adopt_version(spark: SparkSession, schema: str, name: str, version: str, location: str, definition: TableDef, fmt: str = "parquet") -> None:
    """Publish a folder that is there already (from an earlier catalog): its partitions are listed once."""
    ensure_schema(spark, schema)
    create_table(spark, schema, version, location, definition, fmt)
    if definition.partition_cols:
        sync_partitions(spark, quoted(schema, version))
    _point(spark, schema, name, version, definition)
