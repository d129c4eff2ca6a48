"""Names of parts and manifests: pure functions of the options."""

from __future__ import annotations

import re

from tapline.options import ExtractOptions

S3_SCHEME = "s3://"

# What Spark's writer escapes in folder names besides control characters, and its name for null and empty.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def part_name(options: ExtractOptions, index: int) -> str:
    suffix = ".parquet.encrypted" if options.encryption_key else ".parquet"
    return f"{options.prefix or ''}{index:06d}{suffix}"


def part_name_pattern(options: ExtractOptions) -> re.Pattern:
    """Matches the names part_name gives, with the part number as its group."""
    suffix = r"\.parquet\.encrypted" if options.encryption_key else r"\.parquet"
    return re.compile(rf"^{re.escape(options.prefix or '')}([0-9]{{6,}}){suffix}$")


def _bucket_and_folder(base_dir: str) -> tuple[str | None, str]:
    """Bucket (None for a file system path) and the folder below it without a slash at its end."""
    if not base_dir.startswith(S3_SCHEME):
        return None, base_dir.rstrip("/")
    bucket, _, folder = base_dir[len(S3_SCHEME):].partition("/")
    return bucket, folder.rstrip("/")


def part_key(options: ExtractOptions, index: int, table_dir: str | None = None) -> str:
    """Path of a part below its bucket, or below the file system root; it always starts with a slash."""
    _, folder = _bucket_and_folder(options.base_dir)
    pieces = [folder, table_dir or options.table_dir, part_name(options, index)]
    return "/" + "/".join(p for p in pieces if p)


def table_uri(options: ExtractOptions, table_dir: str | None = None) -> str:
    """Folder of the parts as Spark addresses it. Buckets go through the S3A connector; local paths stay as given."""
    bucket, folder = _bucket_and_folder(options.base_dir)
    table = table_dir or options.table_dir
    if bucket is None:
        return f"{folder}/{table}"
    return f"s3a://{bucket}/" + "/".join(p for p in (folder, table) if p)


def folder_name(columns: tuple[str, ...], values: tuple) -> str:
    """Folder of the rows with these values of the directory columns, named as Spark's own writer names it."""
    def escaped(value) -> str:
        text = "" if value is None else str(value)
        return "".join(f"%{ord(c):02X}" if c in ESCAPED or c < " " else c for c in text) or NO_VALUE

    return "/".join(f"{escaped(c)}={escaped(v)}" for c, v in zip(columns, values))


def log_path(log_dir: str, table_dir: str) -> str:
    """Manifest of a table folder: sales/year=2031/month=11/day=30 has sales_2031_11_30.csv."""
    name = table_dir.replace("/", "_")
    for key in ("year=", "month=", "day="):
        name = name.replace(key, "")
    return f"{log_dir}/{name}.csv"
