"""Jobs: the compositions a scheduler runs."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.predicates import choose_predicate, request_rows
from tidemark.functions.weeks import STORED_WEEK, WEEK, iso_week_key
from tidemark.operators.aggregate import weekly_distinct_users, weekly_type_counts
from tidemark.operators.audit import record_writes
from tidemark.operators.fingerprints import changed_partitions, fingerprints, last_fingerprints, log_fingerprints
from tidemark.operators.sinks import append_table, overwrite_all, preview, replace_partitions, writers_for
from tidemark.plans.tables import (
    USER_ACTIVITY,
    WEEKLY_TYPES,
    TableDef,
    ensure_schema,
    ensure_table,
    ensure_tables,
    is_week,
    quoted,
    redefine_table,
    register_partitions,
    table_definition,
    table_partitions,
    weekly_view,
)
from tidemark.plans.versions import current_version, publish_version
from tidemark.storage import folder_exists, partition_folder, remove_folders

# Fixed table set of the overwrite job: table -> schema.
JOB_TABLES = {"user_activity": "idempotent", "daily_activity": "idempotent"}


@dataclass(frozen=True)
class Target:
    """A table the overwrite job can maintain.

    ``build(activity, predicate)`` computes its rows from the activity table;
    the predicate is over the partition keys of ``definition``.
    """

    definition: TableDef
    build: Callable[[DataFrame, Column], DataFrame]


_TARGETS: dict[tuple[str, str], Target] = {
    ("idempotent", "daily_activity"): Target(table_definition("idempotent", "daily_activity"), weekly_distinct_users),
    ("idempotent", "weekly_types"): Target(TableDef(WEEKLY_TYPES, (WEEK, "activity_type")), weekly_type_counts),
}


def register_target(schema: str, table: str, target: Target) -> None:
    """Add or replace the target that ``(schema, table)`` names."""
    _TARGETS[(schema, table)] = target


def target_of(schema: str, table: str) -> Target:
    """The target registered for ``(schema, table)``; ``ValueError`` if none."""
    if (schema, table) not in _TARGETS:
        raise ValueError(f"{schema}.{table} is not a target of the overwrite job; register it first.")
    return _TARGETS[(schema, table)]


def parse_partitions(text: str | None) -> dict[str, list[Any]] | list[dict[str, Any]] | None:
    """Partition request from its JSON text; ``None`` or ``""`` means no request."""
    if text is None or not text.strip():
        return None
    value = json.loads(text)
    if not isinstance(value, (dict, list)):
        raise ValueError("A partition request is a JSON object or a list of objects.")
    return value


def load_scenario(
    spark: SparkSession,
    landing: str,
    target: str,
    scenario: int,
    *,
    mode: str = "overwrite",
    fmt: str = "parquet",
    landing_fmt: str = "parquet",
    files_per_partition: int | None = None,
    rebalance: bool = True,
) -> dict[str, Any]:
    """Load one scenario of the landing data into the activity table.

    The scenario filter is pushed into the landing scan. ``mode="overwrite"``
    (the reference's behaviour) replaces every partition and the schema;
    ``mode="replace"`` (ours) replaces only the weeks present in the landing
    data, so a daily load rewrites days, not the whole history. By default one
    rebalancing shuffle brings each week's rows together, so that landing data
    in any order gives about one file a week, and a hot week several;
    ``files_per_partition`` salts each week over that many tasks instead;
    ``rebalance=False`` writes rows where they are, for landing data that is
    already laid out by week.

    ``mode="changed"`` (ours) is ``replace`` for the weeks whose content differs from
    what the last such load wrote: an aggregate over the landing data gives each
    week's fingerprint (:mod:`tidemark.operators.fingerprints`), and weeks with the
    logged one are not written. The log lies beside the table; a load in another mode
    forgets it, and so does a week whose folder is gone.

    Returns the rows written, the key tuples of the weeks written and the schema.
    """
    if mode not in ("overwrite", "replace", "changed"):
        raise ValueError(f"Unknown load mode {mode!r}; expected overwrite, replace or changed.")
    rows = spark.read.format(landing_fmt).load(landing).where(F.col("scenario") == F.lit(scenario).cast("int"))
    layout = {"fmt": fmt, "files_per_partition": files_per_partition, "rebalance": rebalance and not files_per_partition, "manifest": True}
    log = f"{target.rstrip('/')}__fingerprints"
    if mode == "changed":
        keys = [STORED_WEEK]
        current = fingerprints(rows, keys).persist()  # one row per week
        try:
            weeks = [r[0] for r in changed_partitions(current, last_fingerprints(spark, log, keys), keys).select(STORED_WEEK).collect()]
            same = {r[0] for r in current.select(STORED_WEEK).collect()} - set(weeks)
            weeks += [w for w in same if not folder_exists(spark, f"{target.rstrip('/')}/{partition_folder(spark, {STORED_WEEK: w})}")]
            if not weeks:
                return {"rows": 0, "partitions": [], "schema": rows.schema}
            written = replace_partitions(rows.where(_any_of(STORED_WEEK, weeks)), target, keys, **layout)
            log_fingerprints(current.where(_any_of(STORED_WEEK, weeks)), log)
        finally:
            current.unpersist()
        return written | {"schema": rows.schema}
    remove_folders(spark, [log])
    if mode == "overwrite":
        return overwrite_all(rows, target, [STORED_WEEK], reads_from=[landing], **layout) | {"schema": rows.schema}
    return replace_partitions(rows, target, [STORED_WEEK], **layout) | {"schema": rows.schema}


def _any_of(key: str, values: Sequence[Any]) -> Column:
    """``key`` is one of ``values``, null among them or not."""
    named = F.col(key).isin([v for v in values if v is not None])
    return named | F.col(key).isNull() if None in values else F.col(key).isNotNull() & named


def _check_request(partitions: Any, keys: Sequence[str]) -> None:
    names, _ = request_rows(partitions) if partitions else ([], [])
    if unknown := [n for n in names if n not in keys]:
        raise ValueError(f"A request for this target names {list(keys)}; {unknown} are no partition keys of it.")


def run_overwrite(
    spark: SparkSession,
    *,
    landing: str,
    warehouse: str,
    scenario: int | None,
    backfill: bool = False,
    partitions: Mapping[str, Sequence[Any]] | Sequence[Mapping[str, Any]] | str | None = None,
    table: str = "daily_activity",
    schema: str = JOB_TABLES["daily_activity"],
    target: Target | None = None,
    audit: str | None = None,
    load_mode: str = "overwrite",
    fmt: str = "parquet",
    landing_fmt: str = "parquet",
    files_per_partition: int | None = None,
    rebalance: bool = True,
) -> dict[str, Any]:
    """The idempotent overwrite pipeline.

    1. create the activity table and the target, if absent, in catalog schema
       ``schema`` (at ``<warehouse>/<schema>.db``); a name that is taken by a
       table elsewhere raises;
    2. load: ``scenario`` of the landing data replaces the activity table
       (skipped when ``scenario`` is None). ``load_mode``: ``overwrite``, ``replace`` and
       ``changed`` as in :func:`load_scenario`; ``publish`` writes a new version and
       makes the table's name a view over it (:mod:`tidemark.plans.versions`), so a
       load that fails changes nothing;
    3. choose the predicate: backfill -> all partitions; requested ones ->
       those; after a ``changed`` load of a table whose only key is the week, the
       weeks it wrote; else those newer than the newest the target has;
    4. rebuild the selected partitions of ``table`` from the activity table
       and replace exactly those.

    ``table`` names a registered target (see :func:`register_target`), or
    ``target`` gives one. Both tables are kept in format ``fmt``. The catalog learns
    of the partitions that a write names, and of no others, so no run lists
    all folders; step 4 reads the activity table through the catalog, which lists
    the folders of the weeks selected and no more. Returns the metrics, which ``audit`` (a path) also gets,
    in one append at the end.
    """
    if isinstance(partitions, str):
        partitions = parse_partitions(partitions)
    target = target or target_of(JOB_TABLES["daily_activity"], table)
    keys = list(target.definition.partition_cols)
    _check_request(partitions, keys)
    names = {"user_activity": schema, table: schema}
    activity = table_definition(JOB_TABLES["user_activity"], "user_activity")
    published = load_mode == "publish"
    if published:
        del names["user_activity"]  # a name of the versions, not a table
    places = ensure_tables(spark, names, warehouse, {"user_activity": activity, table: target.definition}, fmt)
    activity_name, target_name = quoted(schema, "user_activity"), quoted(schema, table)
    metrics: dict[str, Any] = {}
    writes = []

    loaded: dict[str, Any] = {}
    if scenario is not None and published:
        rows = spark.read.format(landing_fmt).load(landing).where(F.col("scenario") == F.lit(scenario).cast("int"))
        loaded = publish_version(
            spark, rows, schema, "user_activity", warehouse, activity.partition_cols, fmt=fmt, reads_from=[landing],
            files_per_partition=files_per_partition, rebalance=rebalance and not files_per_partition,
        )
    elif scenario is not None:
        loaded = load_scenario(
            spark, landing, places["user_activity"], scenario, mode=load_mode, fmt=fmt, landing_fmt=landing_fmt,
            files_per_partition=files_per_partition, rebalance=rebalance,
        )
        if load_mode == "overwrite":  # the landing data's schema replaces the table's, in the catalog too
            definition = TableDef(loaded["schema"], activity.partition_cols)
            redefine_table(spark, schema, "user_activity", places["user_activity"], definition, fmt, loaded["partitions"])
        else:
            register_partitions(spark, activity_name, activity.partition_cols, loaded["partitions"])
    # The table that the name means, for its partitions in the catalog.
    activity_table = quoted(schema, current_version(spark, schema, "user_activity")) if published else activity_name
    if loaded:
        metrics["rows_loaded"] = loaded["rows"]
        if audit:
            after = table_partitions(spark, activity_table).count()
            writes.append({"table_name": "user_activity", "operation": load_mode.upper(), "rows": loaded["rows"], "partitions_after": after})

    # The newest partition comes from the catalog's listing, not from a scan.
    current = table_partitions(spark, target_name)
    types = {f.name: f.dataType for f in target.definition.schema.fields}
    if loaded and load_mode == "changed" and not backfill and not partitions and keys == [WEEK]:
        mode, partitions = "changed", [{WEEK: w} for (w,) in loaded["partitions"]]
        predicate = _any_of(WEEK, [w for (w,) in loaded["partitions"]])
    else:
        mode, predicate = choose_predicate(current, keys, backfill=backfill, partitions=partitions, schema={k: types[k] for k in keys})
    metrics.update(mode=mode, partitions_before=current.count())
    if mode == "changed" and not partitions:
        written = {"rows": 0, "partitions": []}
    else:
        rebuilt = target.build(spark.table(activity_name), predicate)
        # Partitions to write: at most those of the activity table, or those requested.
        upper = len(partitions) if mode == "changed" else len(request_rows(partitions)[1]) if mode == "cherry_pick" else table_partitions(spark, activity_table).count()
        written = replace_partitions(rebuilt, places[table], keys, fmt=fmt, writers=writers_for(spark, upper), manifest=True)
    if written["rows"]:
        register_partitions(spark, target_name, keys, written["partitions"])
    metrics.update(rows=written["rows"], partitions_after=table_partitions(spark, target_name).count())
    if audit:
        writes.append({"table_name": table, "operation": f"REPLACE:{mode}", **{k: metrics[k] for k in ("rows", "partitions_before", "partitions_after")}})
        record_writes(spark, audit, writes)
    return metrics


def weekly_table_and_view(
    spark: SparkSession,
    *,
    schema: str,
    table: str,
    view: str,
    week: str,
    location: str,
    schema_location: str | None = None,
    definition: TableDef | None = None,
) -> None:
    """Create the activity table (if absent) and a view over one of its weeks.

    ``definition`` defaults to the registered activity table. Only the folder
    of ``week`` is looked at; where it exists the catalog learns of it.
    """
    ensure_schema(spark, schema, schema_location)
    ensure_table(spark, schema, table, location, definition or table_definition("idempotent", "user_activity"))
    if folder_exists(spark, f"{location.rstrip('/')}/{partition_folder(spark, {STORED_WEEK: week})}"):
        register_partitions(spark, quoted(schema, table), [STORED_WEEK], [(week,)])
    weekly_view(spark, quoted(schema, view), quoted(schema, table), week)


def read_preview_append(
    spark: SparkSession, source: str, table: str, path: str | None = None, n: int = 20
) -> None:
    """Read a Parquet source, print a preview and append it to a table."""
    df = spark.read.parquet(source)
    preview(df, n)
    append_table(df, table, path)


def is_rollover_day(d: Column | str) -> Column:
    """A new period starts: the day is a Monday or the 1st of January."""
    c = F.col(d) if isinstance(d, str) else d
    return (F.dayofweek(c) == 2) | ((F.month(c) == 1) & (F.dayofmonth(c) == 1))


def rollover_days(df: DataFrame, date_col: str = "activity_date") -> DataFrame:
    """Distinct days of ``df`` on which a period table or view is due."""
    return df.select(F.col(date_col).alias("rollover_date")).where(is_rollover_day("rollover_date")).distinct()


def due_weeks(df: DataFrame, date_col: str = "activity_date") -> DataFrame:
    """``year_woy`` of the weeks in which a roll-over day of ``df`` lies."""
    return rollover_days(df, date_col).select(iso_week_key("rollover_date").alias(WEEK)).distinct()


def maintain_weekly_views(spark: SparkSession, *, schema: str, table: str, due: DataFrame, prefix: str = "weekly_") -> dict[str, list[str]]:
    """Make the weekly views those of the due weeks that the table holds; returns the names created and dropped.

    ``due`` has ``year_woy`` (see :func:`due_weeks`). Compared are weeks, not rows: the
    due ones, the table's partitions in the catalog and the views ``<prefix><week>``
    of the schema. Missing views are created; a view whose week the table has lost is
    dropped; a view that stands stays, so a second run changes nothing.
    """
    held = {r[0] for r in table_partitions(spark, quoted(schema, table)).select(STORED_WEEK).collect()}
    wanted = {r[0] for r in due.select(WEEK).distinct().collect()} & held
    views = {t.name for t in spark.catalog.listTables(schema) if t.tableType == "VIEW" and t.name.startswith(prefix)}
    weeks = {v: v.removeprefix(prefix) for v in views if is_week(v.removeprefix(prefix))}
    created = sorted(f"{prefix}{w}" for w in wanted if w is not None and is_week(w) and f"{prefix}{w}" not in views)
    dropped = sorted(v for v, w in weeks.items() if w not in held)
    for view in created:
        weekly_view(spark, quoted(schema, view), quoted(schema, table), view.removeprefix(prefix))
    for view in dropped:
        spark.sql(f"DROP VIEW IF EXISTS {quoted(schema, view)}")
    return {"created": created, "dropped": dropped}


__all__ = [
    "JOB_TABLES",
    "USER_ACTIVITY",
    "Target",
    "due_weeks",
    "is_rollover_day",
    "load_scenario",
    "maintain_weekly_views",
    "parse_partitions",
    "read_preview_append",
    "register_target",
    "rollover_days",
    "run_overwrite",
    "target_of",
    "weekly_table_and_view",
]
