"""Partition-selection predicates.

Each strategy returns a boolean ``Column`` to filter the *source* of a
partition-scoped recomputation:

* ``latest``      - only partitions newer than the newest one in the target;
* ``cherry_pick`` - only explicitly requested partitions (the repair path);
* ``everything``  - all partitions (a full backfill).

Rows whose key is NULL always pass, in ``latest`` and ``cherry_pick`` alike.
Predicates are plain Catalyst expressions, so when they touch only partition
columns they prune directories at planning time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _and(cols: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols, F.lit(True))


def _or(cols: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols, F.lit(False))


def everything() -> Column:
    """Trivial strategy: select every partition."""
    return F.lit(True)


def latest(
    target: DataFrame,
    partition_cols: Sequence[Column | str],
    *,
    tuple_order: bool = False,
) -> Column:
    """Keys strictly newer than the newest key row of ``target``.

    The newest row is the first one after sorting every key descending (NULLs
    last). The default comparison is column by column, joined with AND:
    ``(k1 IS NULL OR k1 > v1) AND (k2 IS NULL OR k2 > v2) ...``. Late rows for
    an already present partition are therefore not selected; use
    ``cherry_pick`` to repair those.

    ``tuple_order=True`` (our addition) compares the key tuple
    lexicographically instead: ``k1 > v1 OR (k1 = v1 AND k2 > v2) ...``, with
    rows having any NULL key passing.

    Raises ``ValueError`` when ``target`` has no rows. Runs one small job: a
    top-1 over the key columns only (per-task top-1, then a merge of one row
    per task), which reads no data columns.
    """
    cols = [_col(c) for c in partition_cols]
    if not cols:
        raise ValueError("latest needs at least one partition column.")
    top = target.select(*cols).orderBy(*[c.desc_nulls_last() for c in cols]).head(1)
    if not top:
        raise ValueError("Cannot find the latest partition.")
    values = list(top[0])
    if not tuple_order:
        return _and(c.isNull() | (c > F.lit(v)) for c, v in zip(cols, values))
    any_null = _or(c.isNull() for c in cols)
    later = F.lit(False)
    for c, v in reversed(list(zip(cols, values))):
        later = (c > F.lit(v)) | ((c == F.lit(v)) & later)
    return any_null | later


def request_rows(requests: Any) -> tuple[list[str], list[tuple]]:
    """Normalise a request into (key names, list of value tuples)."""
    if isinstance(requests, DataFrame):
        raise TypeError(
            "cherry_pick takes driver-side requests; for a DataFrame of keys "
            "use tidemark.operators.select.keep_requested (a join)."
        )
    if isinstance(requests, Mapping):
        if len(requests) > 1:
            raise ValueError(
                "A dict request names one key column; for several columns "
                "pass a list of key tuples such as "
                "[{'year_woy': '2024_01', 'activity_type': 'click'}]."
            )
        ((name, values),) = requests.items() if requests else ((None, []),)
        if isinstance(values, (str, bytes)) or not isinstance(values, Iterable):
            values = [values]
        return ([name] if name else []), [(v,) for v in values]
    rows = list(requests)
    if not rows:
        return [], []
    first = rows[0]
    names = list(first.asDict().keys() if isinstance(first, Row) else first.keys())
    out = []
    for r in rows:
        d = r.asDict() if isinstance(r, Row) else dict(r)
        if set(d) != set(names):
            raise ValueError(f"Request {d} does not name exactly the keys {names}.")
        out.append(tuple(d[n] for n in names))
    return names, out


def _typed(value: Any, dtype: DataType | None) -> Column:
    lit = F.lit(value)
    return lit.cast(dtype) if dtype is not None else lit


def cherry_pick(
    requests: Mapping[str, Sequence[Any]] | Sequence[Mapping[str, Any]] | Sequence[Row],
    *,
    schema: StructType | Mapping[str, DataType] | None = None,
) -> Column:
    """Rows whose key matches one requested key tuple.

    ``requests`` is either ``{"year_woy": ["2024_01", "2024_04"]}`` (one key
    column) or a list of key tuples such as
    ``[{"year_woy": "2024_01", "activity_type": "click"}, ...]``. A key field
    that is NULL in the data matches any requested value. An empty request
    selects nothing.

    ``schema`` (the source schema, or name -> type) casts each requested value
    to its column's type, so ``"7"`` against an INT key compares as ``7``.

    One plan for requests of any size. Every key must hold a value requested
    for it (``k IS NULL OR k IN (...)``: on a partition column this prunes
    directories); with several keys, the non-NULL keys must also form one of
    the requested sub-tuples, a hash lookup per NULL pattern of the keys. The
    values travel in the plan: a request that is itself data belongs in a
    DataFrame, see ``tidemark.operators.select.keep_requested``.
    """
    names, tuples = request_rows(requests)
    if not tuples:
        return F.lit(False)
    if isinstance(schema, StructType):
        types = {f.name: f.dataType for f in schema.fields}
    else:
        types = dict(schema or {})
    cols = {n: F.col(n) for n in names}

    def values(i: int) -> list[Column]:
        return [_typed(v, types.get(names[i])) for v in sorted({t[i] for t in tuples}, key=repr)]

    per_key = _and(cols[n].isNull() | cols[n].isin(values(i)) for i, n in enumerate(names))
    if len(names) == 1:
        return per_key
    patterns = []
    for mask in range(1 << len(names)):
        null_keys = [n for i, n in enumerate(names) if mask >> i & 1]
        live = [n for n in names if n not in null_keys]
        shape = _and([cols[n].isNull() for n in null_keys] + [cols[n].isNotNull() for n in live])
        if len(live) > 1:  # a single key is decided by ``per_key`` already
            at = [names.index(n) for n in live]
            wanted = [
                F.struct(*[_typed(v, types.get(n)).alias(n) for n, v in zip(live, sub)])
                for sub in sorted({tuple(t[i] for i in at) for t in tuples}, key=repr)
            ]
            shape = shape & F.struct(*[cols[n].alias(n) for n in live]).isin(wanted)
        patterns.append(shape)
    return per_key & _or(patterns)


_STRATEGIES: dict[str, Callable[..., Column]] = {
    "latest": latest,
    "cherry_pick": cherry_pick,
    "trivial": everything,
}


def strategy(name: str, *args: Any, **kwargs: Any) -> Column:
    """Run a strategy by name (case-insensitive): latest, cherry_pick, trivial."""
    fn = _STRATEGIES.get(name.strip().lower())
    if fn is None:
        raise ValueError(
            f"Unknown partition strategy {name!r}; expected one of {sorted(_STRATEGIES)}."
        )
    return fn(*args, **kwargs)


def choose_predicate(
    target: DataFrame | None,
    partition_cols: Sequence[Column | str],
    *,
    backfill: bool = False,
    partitions: Any = None,
    schema: StructType | Mapping[str, DataType] | None = None,
) -> tuple[str, Column]:
    """Mode choice of the overwrite job: backfill, else requested, else latest.

    Returns ``(mode name, predicate)``. An empty or ``None`` request falls
    through to ``latest``, which needs a non-empty target.
    """
    if backfill:
        return "trivial", everything()
    if partitions:
        return "cherry_pick", cherry_pick(partitions, schema=schema)
    if target is None:
        raise ValueError("latest needs the target table.")
    return "latest", latest(target, partition_cols)
