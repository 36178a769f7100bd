"""Source catalog: a configuration of many sources, keyed by format, then by name."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.readers import parse_source, read_source


def _parsed(path: str | Path) -> Mapping[str, Any]:
    text = Path(path).read_text()
    if Path(path).suffix not in (".yaml", ".yml"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover - yaml is optional
        raise ValueError("Reading a YAML catalog needs PyYAML; pass a dict or JSON instead.") from exc
    return yaml.safe_load(text) or {}


def load_catalog(config: Mapping[str, Any] | str | Path) -> dict[str, dict[str, Any]]:
    """Sources by name from ``{format: {name: entry}}``, given as a mapping or a YAML or JSON file.

    The top-level key ``defaults`` is skipped; an unknown format raises
    ``ValueError``. Names are global across formats: the last one counts.
    """
    tree = config if isinstance(config, Mapping) else _parsed(config)
    flat = [(str(fmt).lower(), name, entry) for fmt, group in tree.items() if fmt != "defaults" for name, entry in (group or {}).items()]
    return {name: parse_source(fmt, name, entry) for fmt, name, entry in flat}


def read_catalog(spark: SparkSession, config: Mapping[str, Any] | str | Path) -> dict[str, DataFrame]:
    """Every source of the catalog as a lazily read DataFrame."""
    return {name: read_source(spark, source) for name, source in load_catalog(config).items()}
