from tidemark.plans.jobs import (
    is_rollover_day,
    load_scenario,
    parse_partitions,
    Target,
    read_preview_append,
    register_target,
    rollover_days,
    run_overwrite,
    weekly_table_and_view,
)
from tidemark.plans.tables import (
    DAILY_ACTIVITY,
    USER_ACTIVITY,
    TableDef,
    ensure_schema,
    ensure_table,
    check_table,
    ensure_tables,
    partition_columns,
    quoted,
    read_table,
    redefine_table,
    sync_partitions,
    table_definition,
    table_exists,
    table_location,
    table_partitions,
    weekly_view,
)

__all__ = [
    "DAILY_ACTIVITY",
    "USER_ACTIVITY",
    "TableDef",
    "Target",
    "check_table",
    "ensure_schema",
    "ensure_table",
    "ensure_tables",
    "is_rollover_day",
    "load_scenario",
    "parse_partitions",
    "partition_columns",
    "quoted",
    "read_table",
    "redefine_table",
    "register_target",
    "read_preview_append",
    "rollover_days",
    "run_overwrite",
    "sync_partitions",
    "table_definition",
    "table_exists",
    "table_location",
    "table_partitions",
    "weekly_table_and_view",
    "weekly_view",
]
