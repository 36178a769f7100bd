"""Table definitions, DDL and table metadata."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.functions.weeks import STORED_WEEK, WEEK
from tidemark.operators.sinks import same_path
from tidemark.storage import subfolders

USER_ACTIVITY = StructType(
    [
        StructField("user_id", LongType()),
        StructField("activity_date", DateType()),
        StructField("activity_type", StringType()),
        StructField(STORED_WEEK, StringType(), nullable=False),
    ]
)

DAILY_ACTIVITY = StructType(
    [
        StructField(WEEK, StringType()),
        StructField("distinct_daily_users", IntegerType()),
    ]
)

WEEKLY_TYPES = StructType(
    [
        StructField(WEEK, StringType()),
        StructField("activity_type", StringType()),
        StructField("events", LongType()),
    ]
)


@dataclass(frozen=True)
class TableDef:
    """Declared columns and partition keys of one table."""

    schema: StructType
    partition_cols: tuple[str, ...]

    def ddl(self) -> str:
        return ", ".join(
            f"`{f.name}` {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
            for f in self.schema.fields
        )

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)


_TABLES: dict[tuple[str, str], TableDef] = {
    ("idempotent", "user_activity"): TableDef(USER_ACTIVITY, (STORED_WEEK,)),
    ("idempotent", "daily_activity"): TableDef(DAILY_ACTIVITY, (WEEK,)),
    ("idempotent", "weekly_types"): TableDef(WEEKLY_TYPES, (WEEK, "activity_type")),
}


def table_definition(schema: str, table: str) -> TableDef:
    """Definition registered for ``(schema, table)``; ``ValueError`` if none."""
    try:
        return _TABLES[(schema, table)]
    except KeyError:
        known = ", ".join(sorted(".".join(k) for k in _TABLES))
        raise ValueError(f"Nothing is registered under {schema}.{table} (known: {known}).") from None


def register_table(schema: str, table: str, definition: TableDef) -> None:
    """Add or replace a table definition."""
    _TABLES[(schema, table)] = definition


def quoted(schema: str, table: str) -> str:
    """Catalog identifier with both parts backticked."""
    return f"`{schema.replace('`', '``')}`.`{table.replace('`', '``')}`"


def _sql_string(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``, at ``location`` when given."""
    loc = f" LOCATION {_sql_string(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema.replace('`', '``')}`{loc}")


def _nothing_there(e: AnalysisException) -> bool:
    """The path does not exist, or holds no data file yet; any other failure is an error."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_exists(spark: SparkSession, name: str | None = None, path: str | None = None, fmt: str = "parquet") -> bool:
    """Catalog entry for ``name`` exists, or data can be read at ``path``."""
    if name is not None:
        return spark.catalog.tableExists(name)
    if path is None:
        raise ValueError("table_exists needs a name or a path.")
    return read_table(spark, path, fmt) is not None


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """Location and provider of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name in ('Location', 'Provider')").collect()
    return {r.col_name: r.data_type for r in rows}


def check_table(spark: SparkSession, schema: str, table: str, location: str, definition: TableDef, fmt: str = "parquet") -> None:
    """``ValueError`` unless the catalog table has this location, format, partition keys and at least these columns."""
    name = quoted(schema, table)
    found = _described(spark, name)
    columns = {c.name: c.dataType for c in spark.catalog.listColumns(f"{schema}.{table}")}
    wrong = []
    if same_path(found["Location"]) != same_path(location):
        wrong.append(f"it is at {found['Location']}, not {location}")
    if found["Provider"].lower() != fmt.lower():
        wrong.append(f"its format is {found['Provider']}, not {fmt}")
    wrong += [
        f"column {f.name} is {columns.get(f.name, 'missing')}, not {f.dataType.simpleString()}"
        for f in definition.schema.fields
        if columns.get(f.name) != f.dataType.simpleString()
    ]
    keys = partition_columns(spark, f"{schema}.{table}")
    if keys != list(definition.partition_cols):
        wrong.append(f"it is partitioned by {keys}, not {list(definition.partition_cols)}")
    if wrong:
        raise ValueError(f"Table {schema}.{table} exists, but " + "; ".join(wrong) + ".")


def ensure_table(
    spark: SparkSession,
    schema: str,
    table: str,
    location: str,
    definition: TableDef | None = None,
    fmt: str = "parquet",
    schema_location: str | None = None,
) -> bool:
    """Create the schema and a partitioned external table if absent.

    Returns True when the table was created by this call. A table that is
    there must agree (:func:`check_table`): another location or other columns
    under the name raise ``ValueError``.
    """
    definition = definition or table_definition(schema, table)
    ensure_schema(spark, schema, schema_location)
    if spark.catalog.tableExists(f"{schema}.{table}"):
        check_table(spark, schema, table, location, definition, fmt)
        return False
    create_table(spark, schema, table, location, definition, fmt)
    if definition.partition_cols and subfolders(spark, location):  # data of an earlier catalog: its partitions are listed once, here
        sync_partitions(spark, quoted(schema, table))
    return True


def create_table(spark: SparkSession, schema: str, table: str, location: str, definition: TableDef, fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS`` of a partitioned external table; its catalog entry starts without partitions."""
    parts = ", ".join(f"`{c}`" for c in definition.partition_cols)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(schema, table)} ({definition.ddl()}) USING {fmt}"
        + (f" PARTITIONED BY ({parts})" if parts else "")
        + f" LOCATION {_sql_string(location)}"
    )


def redefine_table(
    spark: SparkSession,
    schema: str,
    table: str,
    location: str,
    definition: TableDef,
    fmt: str = "parquet",
    partitions: Sequence[tuple] | None = None,
) -> None:
    """After a full overwrite by path: give the catalog table the new columns and exactly the partitions that are there.

    ``partitions`` is the manifest of the write; without it the folder is listed.
    With the columns it had, the table stays and only its partitions change;
    other columns mean a new entry, between dropping the old one and
    creating it the name is gone (:func:`tidemark.plans.versions.publish_version`
    has no such gap). The table is external, so dropping its entry leaves the data.
    """
    name, keys = quoted(schema, table), list(definition.partition_cols)
    if spark.catalog.tableExists(f"{schema}.{table}") and _same_columns(spark, f"{schema}.{table}", definition):
        if keys and partitions is not None:
            had = {tuple(r) for r in table_partitions(spark, name).select(*keys).collect()}
            drop_partitions(spark, name, keys, had - set(partitions))
            register_partitions(spark, name, keys, partitions)
        elif keys:
            sync_partitions(spark, name)
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, schema, table, location, definition, fmt)
    if keys and partitions is not None:
        register_partitions(spark, name, keys, partitions)
    elif keys:
        sync_partitions(spark, name)


def _same_columns(spark: SparkSession, name: str, definition: TableDef) -> bool:
    keys = list(definition.partition_cols)
    declared = [f for f in definition.schema.fields if f.name not in keys] + [definition.schema[k] for k in keys]
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(name)] == [(f.name, f.dataType.simpleString()) for f in declared]


def _partition_clauses(keys: Sequence[str], partitions: Iterable[tuple]) -> list[str]:
    def literal(v: Any) -> str:
        return "null" if v is None else _sql_string(str(v))

    return ["PARTITION (" + ", ".join(f"`{k}`={literal(v)}" for k, v in zip(keys, values)) + ")" for values in partitions]


_PER_STATEMENT = 200


def register_partitions(spark: SparkSession, name: str, keys: Sequence[str], partitions: Iterable[tuple]) -> None:
    """Tell the catalog of these partitions (key tuples), and of no other: no folder is listed."""
    clauses = _partition_clauses(keys, partitions)
    for at in range(0, len(clauses), _PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(clauses[at : at + _PER_STATEMENT]))
    spark.catalog.refreshTable(name)


def drop_partitions(spark: SparkSession, name: str, keys: Sequence[str], partitions: Iterable[tuple]) -> None:
    """Take these partitions out of the catalog; the table is external, so files stay where they are."""
    clauses = _partition_clauses(keys, partitions)
    for at in range(0, len(clauses), _PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(clauses[at : at + _PER_STATEMENT]))
    spark.catalog.refreshTable(name)


def sync_partitions(spark: SparkSession, name: str) -> None:
    """Make the catalog's partitions those of the directory: new ones are added, vanished ones dropped."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def ensure_tables(
    spark: SparkSession,
    tables: dict[str, str],
    warehouse: str,
    definitions: dict[str, TableDef] | None = None,
    fmt: str = "parquet",
) -> dict[str, str]:
    """Create every table of a job (table -> schema) below ``warehouse``.

    Schemas live at ``<warehouse>/<schema>.db``, tables inside them.
    ``definitions`` (table -> definition) replaces registered ones.
    Returns table -> location.
    """
    out = {}
    for table, schema in tables.items():
        loc = table_location(warehouse, schema, table)
        ensure_table(spark, schema, table, loc, (definitions or {}).get(table), fmt, f"{warehouse.rstrip('/')}/{schema}.db")
        out[table] = loc
    return out


def table_location(warehouse: str, schema: str, table: str) -> str:
    """``<warehouse>/<schema>.db/<table>``."""
    return f"{warehouse.rstrip('/')}/{schema}.db/{table}"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a catalog table, in declared order."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


_WEEK = re.compile(r"\d{4}_\d{2}")


def is_week(text: str) -> bool:
    """``text`` has the form YYYY_WW."""
    return bool(_WEEK.fullmatch(text))


def weekly_view(
    spark: SparkSession,
    view: str,
    table: str,
    week: str,
    columns: Sequence[str] = ("user_id", "activity_date", "activity_type"),
    week_col: str = STORED_WEEK,
) -> None:
    """``CREATE OR REPLACE VIEW view AS SELECT columns FROM table WHERE week_col = week``.

    The view reads one week directory through partition pruning.
    """
    if not is_week(week):
        raise ValueError(f"Week {week!r} is not of the form YYYY_WW.")
    cols = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {cols} FROM {table} "
        f"WHERE `{week_col}` = {_sql_string(week)}"
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None when there is no data there yet; other failures are raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if not _nothing_there(e):
            raise
        return None


def table_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The partitions the catalog has of ``name``: one row each, typed like the partition columns."""
    keys = [(c.name, c.dataType) for c in spark.catalog.listColumns(name) if c.isPartition]
    if not keys:
        raise ValueError(f"{name} has no partition columns.")
    listed = spark.sql(f"SHOW PARTITIONS {name}")
    segments = F.split("partition", "/")

    def value(i: int, dtype: str):
        raw = F.substring_index(segments[i], "=", -1)  # '=' inside a value is escaped
        plain = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
        return F.when(raw != "__HIVE_DEFAULT_PARTITION__", plain).cast(dtype)

    return listed.select(*[value(i, dtype).alias(k) for i, (k, dtype) in enumerate(keys)])
