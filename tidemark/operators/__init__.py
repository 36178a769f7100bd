from tidemark.operators.aggregate import latest_partition, weekly_distinct_users, weekly_type_counts
from tidemark.operators.audit import delta_is_fresh, record_writes, table_history
from tidemark.operators.select import keep_requested, requests_frame, select_partitions
from tidemark.operators.sinks import append_table, overwrite_all, preview, replace_partitions, write_sink

__all__ = [
    "append_table",
    "delta_is_fresh",
    "keep_requested",
    "latest_partition",
    "overwrite_all",
    "preview",
    "record_writes",
    "replace_partitions",
    "requests_frame",
    "select_partitions",
    "table_history",
    "weekly_distinct_users",
    "weekly_type_counts",
    "write_sink",
]
