"""Folders of partitioned tables, through the Hadoop file system of the session."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def partition_folder(spark: SparkSession, values: Mapping[str, Any]) -> str:
    """The folder of one partition below its table, spelled as Spark does (escapes, the name for null)."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(utils.getPartitionPathString(k, None if v is None else str(v)) for k, v in values.items())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders (``key=value``) right below ``path``; none where it does not exist."""
    fs, place = _place(spark, path)
    try:
        found = fs.listStatus(place)
    except Exception as e:
        if "FileNotFoundException" not in str(e):
            raise
        return []
    return sorted(f.getPath().getName() for f in found if f.isDirectory() and "=" in f.getPath().getName())


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders with what is in them; one that is gone already is no error."""
    for path in paths:
        fs, place = _place(spark, path)
        fs.delete(place, True)
