"""Configured sources: one entry of a configuration in, a lazily read DataFrame out.

A source is a plain mapping: ``name``, ``format``, ``location``, ``schema``,
``options`` and ``metadata``. ``READERS`` maps each format to the function that
reads it; :func:`register_format` adds one.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

log = logging.getLogger(__name__)


def schema_from_json(source: str | Path | Mapping[str, Any]) -> StructType:
    """A ``StructType`` from its JSON form: a mapping, JSON text or a JSON file."""
    if isinstance(source, Mapping):
        return StructType.fromJson(dict(source))
    text = str(source)
    return StructType.fromJson(json.loads(text if text.lstrip().startswith("{") else Path(text).read_text()))


def _schema(value: Any) -> StructType | None:
    if value is None or isinstance(value, StructType):
        return value
    if isinstance(value, str) and not value.lstrip().startswith("{") and not Path(value).exists():
        return StructType.fromDDL(value)
    return schema_from_json(value)


def _files(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    """A file source, read with the declared schema (no inference pass) and the options as given.

    Like in Spark itself, a CSV file has no header line unless they say so.
    """
    reader = spark.read.format(source["format"]).options(**source["options"])
    return (reader.schema(source["schema"]) if source["schema"] is not None else reader).load(source["location"])


def jdbc_options(source: Mapping[str, Any]) -> dict[str, str]:
    """Reader options of a JDBC source, checked for a parallel read.

    With ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` Spark opens ``numPartitions`` connections, each reading
    one stride of the column; without them one task reads the whole table.
    """
    options, name = {"url": source["location"], **source["options"]}, source["name"]
    if not options.keys() & {"dbtable", "query"}:
        raise ValueError(f"JDBC source {name!r} needs 'dbtable' or 'query'.")
    bounds = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    stride = [k for k in bounds[:3] if k in options]
    if stride and any(k not in options for k in bounds):
        raise ValueError(f"JDBC source {name!r}: a parallel read needs all of {bounds}.")
    if not stride:
        log.warning("JDBC source %s has no partitionColumn: it is read by a single task.", name)
    if source["schema"] is not None:
        declared = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source["schema"].fields)
        options.setdefault("customSchema", declared)
    return options


def _jdbc(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(source)).load()


def _delta(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    try:
        return spark.read.format("delta").options(**source["options"]).load(source["location"])
    except Exception as exc:  # the data source class is missing without the package
        if "delta" in str(exc).lower() and ("not find" in str(exc).lower() or "DATA_SOURCE_NOT_FOUND" in str(exc)):
            raise ValueError("The Delta format needs the delta-spark package on the classpath.") from exc
        raise


Reader = Callable[[SparkSession, Mapping[str, Any]], DataFrame]
READERS: dict[str, Reader] = {"csv": _files, "json": _files, "parquet": _files, "jdbc": _jdbc, "delta": _delta}
_SCHEMA_REQUIRED = {"csv", "json", "parquet"}


def register_format(fmt: str, reader: Reader, schema_required: bool = False) -> None:
    """Make ``reader(spark, source)`` read the sources of format ``fmt``."""
    READERS[fmt] = reader
    (_SCHEMA_REQUIRED.add if schema_required else _SCHEMA_REQUIRED.discard)(fmt)


def parse_source(fmt: str, name: str, entry: Mapping[str, Any]) -> dict[str, Any]:
    """The source that one configuration entry describes.

    ``path`` and ``schema`` are required for CSV and Parquet; JDBC takes its URL
    as ``path`` or ``url`` and may omit the schema. ``schema`` is the JSON form,
    a JSON file, a DDL string or a ``StructType``.
    """
    if fmt not in READERS:
        raise ValueError(f"Unknown source format {fmt!r}; expected one of {sorted(READERS)}.")
    location = entry.get("path", entry.get("url"))
    for key, missing in (("path", not location), ("schema", fmt in _SCHEMA_REQUIRED and entry.get("schema") is None)):
        if missing:
            raise ValueError(f"Source {name!r} ({fmt}) needs a {key!r}.")
    return {
        "name": name,
        "format": fmt,
        "location": str(location),
        "schema": _schema(entry.get("schema")),
        "options": {k: str(v) for k, v in (entry.get("options") or {}).items()},
        "metadata": dict(entry.get("metadata") or {}),
    }


def read_source(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    """Lazily read a source, see :func:`parse_source`."""
    return READERS[source["format"]](spark, source)


_RECORD, _FILE, _BAD = "_malformed_record", "_malformed_file", "_malformed"


def stage_source(spark: SparkSession, source: Mapping[str, Any], staging: str) -> dict[str, Any]:
    """Read a CSV or JSON source once, parting good rows from malformed records.

    A record is malformed when it does not parse as the declared schema: a value of
    another type, too few or too many fields, broken quoting or braces. One pass parses
    every column of every record, counts both kinds and writes them below ``staging``,
    which must be new; nothing is dropped.

    Returns ``good`` (the declared columns), ``bad`` (the raw record and its file) and
    the counts ``rows`` and ``rejected``. An option ``mode`` of the source is not used.
    """
    if source["format"] not in ("csv", "json"):
        raise ValueError(f"Source {source['name']!r}: malformed records exist in CSV and JSON, not in {source['format']}.")
    declared = source["schema"]
    if declared is None:
        raise ValueError(f"Source {source['name']!r} needs a schema to tell malformed records.")
    if clash := {_RECORD, _FILE, _BAD} & set(declared.fieldNames()):
        raise ValueError(f"Source {source['name']!r}: the columns {sorted(clash)} are used for malformed records.")
    options = {k: v for k, v in source["options"].items() if k.lower() not in ("mode", "columnnameofcorruptrecord", "columnpruning")}
    # A nullable copy: a file can hold a null anywhere. Without column pruning every value is parsed.
    schema = StructType([*(StructField(f.name, f.dataType) for f in declared.fields), StructField(_RECORD, StringType())])
    reader = spark.read.format(source["format"]).options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD)
    rows = reader.option("columnPruning", "false").schema(schema).load(source["location"])
    bad = F.col(_RECORD).isNotNull()
    flagged = rows.withColumns({_FILE: F.when(bad, F.col("_metadata.file_path")), _BAD: bad})
    seen = Observation()
    counted = flagged.observe(seen, F.count_if(~F.col(_BAD)).alias("rows"), F.count_if(_BAD).alias("rejected"))
    counted.write.partitionBy(_BAD).parquet(staging)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    back = StructType([*schema.fields, StructField(_FILE, StringType())])

    def part(flag: bool) -> DataFrame:
        if not counts["rejected" if flag else "rows"]:
            return spark.createDataFrame([], back)
        return spark.read.schema(back).parquet(f"{staging.rstrip('/')}/{_BAD}={str(flag).lower()}")

    good = part(False).select(*(f.name for f in declared.fields))
    return {"good": good, "bad": part(True).select(F.col(_RECORD).alias("record"), F.col(_FILE).alias("file")), **counts}
