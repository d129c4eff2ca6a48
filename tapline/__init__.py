"""Database extraction on PySpark: query results as typed, numbered Parquet parts with a manifest, or as JSON rows."""

from tapline.api import extract, extract_to_parquet, read_to_json, read_to_parquet
from tapline.errors import ExtractionError
from tapline.operators.envelope import read_encrypted
from tapline.operators.json_rows import json_rows, rows_as_dicts
from tapline.operators.manifest import progress, read_manifest, reconcile
from tapline.operators.many import extract_many
from tapline.operators.parts import write_parts
from tapline.options import SESSION_TABLES, ConnectionOptions, ExtractOptions, Split
from tapline.plans.profiles import Switches, normalise

__all__ = [
    "SESSION_TABLES", "ConnectionOptions", "ExtractOptions", "ExtractionError", "Split", "Switches", "extract",
    "extract_many", "extract_to_parquet", "json_rows", "normalise", "progress", "read_encrypted", "read_manifest",
    "read_to_json", "read_to_parquet", "reconcile", "rows_as_dicts", "write_parts",
]
