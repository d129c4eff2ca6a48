"""The one exception type of the public API."""

from __future__ import annotations

import re
from contextlib import contextmanager

# Message prefixes by error kind (empty where the cause speaks for itself).
PREFIXES = {
    "sync": "Join handle error: ",
    "channel": "Sender/Receiver error: ",
    "connection": "Connection error: ",
    "database": "Database error: ",
    "io": "IO error: ",
    "not_implemented": "Not Implemented error: ",
    "data": "Data error: ",
    "arrow": "",
    "parquet": "",
    "oracle": "",
    "odbc": "",
    "postgres": "",
    "storage": "",
    "encryption": "",
}


class ExtractionError(OSError):
    """Raised for every failure of an extraction; ``kind`` is a key of PREFIXES."""

    def __init__(self, kind: str, message: str):
        if kind not in PREFIXES:
            raise ValueError(f"unknown error kind {kind!r}")
        self.kind = kind
        super().__init__(PREFIXES[kind] + message)


# Where a failure came from, told by the class name or SQLSTATE that the JVM reports.
_KIND_BY_PATTERN = (
    ("data", re.compile(r"Failed to convert bytes to UTF|USER_RAISED_EXCEPTION|NUMERIC_VALUE_OUT_OF_RANGE"
                        r"|CAST_INVALID_INPUT|CAST_OVERFLOW|ARITHMETIC_OVERFLOW")),
    ("connection", re.compile(r"SQLNonTransientConnectionException|SQLTransientConnectionException"
                              r"|No suitable driver|ClassNotFoundException|Failed to (?:start|connect to|create) database|Database '[^']*' not found"
                              r"|Connection refused|SQLSTATE:? 08")),
    ("database", re.compile(r"java\.sql\.|SQLException|SQLSyntaxErrorException|JDBC_EXTERNAL_ENGINE")),
    ("not_implemented", re.compile(r"UNSUPPORTED_|UNRECOGNIZED_SQL_TYPE")),
    ("io", re.compile(r"java\.io\.|java\.nio\.file|FileNotFoundException|PATH_NOT_FOUND")),
)

_RAISED_TEXT = re.compile(r"Column: .*?, Error: Failed to convert bytes to UTF-(?:8|16) string")


def classify(text: str, default: str = "database") -> str:
    """Error kind for the text of a Spark or JDBC failure."""
    for kind, pattern in _KIND_BY_PATTERN:
        if pattern.search(text):
            return kind
    return default


def scrub(text: str, secrets: tuple[str | None, ...]) -> str:
    """Remove credentials from a message, given ones and any that stand in a url or key=value list."""
    for secret in secrets:
        if secret:
            text = text.replace(secret, "***")
    text = re.sub(r"(?i)\b(password|pwd)\s*=\s*[^;&,\s]+", r"\1=***", text)
    return re.sub(r"(://[^:/@\s]+):[^@/\s]+@", r"\1:***@", text)


@contextmanager
def as_extraction_error(*secrets: str | None):
    """Re-raise whatever Spark, py4j or the file system throws as an ExtractionError with its cause."""
    try:
        yield
    except ExtractionError:
        raise
    except Exception as err:
        text = str(err)
        raised = _RAISED_TEXT.search(text)
        message = raised.group(0) if raised else text
        default = "io" if isinstance(err, OSError) else "database"
        raise ExtractionError(classify(text, default), scrub(message, secrets)) from err
