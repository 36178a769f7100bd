from tidemark.sources.catalog import load_catalog, read_catalog
from tidemark.sources.readers import jdbc_options, parse_source, read_source, register_format, schema_from_json, stage_source

__all__ = ["jdbc_options", "load_catalog", "parse_source", "read_catalog", "read_source", "register_format", "schema_from_json", "stage_source"]
