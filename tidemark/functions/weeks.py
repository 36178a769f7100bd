"""Week keys and the activity frame the jobs work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed names: the partition column as stored in the activity table, and the
# name it carries after projection in the weekly aggregate.
STORED_WEEK = "__year_week_of_year__"
WEEK = "year_woy"


def iso_week_key(ts: Column | str) -> Column:
    """ISO year and ISO week, zero padded: ``YYYY_WW``.

    Uses the week-based year, so 2024-12-30 is ``2025_01`` and 2021-01-01 is
    ``2020_53``. The string sorts in time order. ``TIMESTAMP_NTZ`` and ``DATE``
    inputs give keys that do not depend on the session time zone.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    year = F.lpad(F.extract(F.lit("YEAROFWEEK"), c).cast("string"), 4, "0")
    week = F.lpad(F.weekofyear(c).cast("string"), 2, "0")
    return F.concat_ws("_", year, week)


def activity_frame(
    df: DataFrame,
    *,
    user: str = "user_id",
    ts: str = "ts",
    kind: str = "event_type",
    scenario_of: str | None = "event_id",
) -> DataFrame:
    """Landing rows of the activity table from an event-like table.

    Columns: ``user_id, activity_date, activity_type, __year_week_of_year__``
    and, when ``scenario_of`` is given, ``scenario = scenario_of % 3`` (the
    load-variant tag the overwrite job filters on).
    """
    cols = [
        F.col(user).cast("bigint").alias("user_id"),
        F.to_date(ts).alias("activity_date"),
        F.col(kind).cast("string").alias("activity_type"),
        iso_week_key(ts).alias(STORED_WEEK),
    ]
    if scenario_of is not None:
        cols.append((F.col(scenario_of) % 3).cast("int").alias("scenario"))
    return df.select(*cols)


def orders_activity(orders: DataFrame) -> DataFrame:
    """Activity rows from ``orders``: customer, order date, order priority."""
    return activity_frame(
        orders,
        user="o_custkey",
        ts="o_orderdate",
        kind="o_orderpriority",
        scenario_of="o_orderkey",
    )
