"""What to read and where to put it."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from tapline.errors import ExtractionError

# Names a caller may pass as datasource_type.
DATASOURCE_TYPES = ("ORACLE", "ODBC", "POSTGRES")

# Rows per fetch batch for the Parquet and the JSON result, batches per output file.
DEFAULT_BATCH_SIZE = 50_000
JSON_BATCH_SIZE = 2_000
BATCHES_PER_PART = 10

# A connection string that names the session's own tables instead of a database.
SESSION_TABLES = "spark:tables"


@dataclass(frozen=True)
class Split:
    """How one query is cut into parallel reads: a column, or predicates that cover all rows.

    Along a column the database counts where the cuts have to be for ranges of about equally many rows. With both bounds the
    ranges are equal strides between them, with ``days`` they begin at those dates; nothing is counted then.
    """

    column: str | None = None
    lower: object = None
    upper: object = None
    partitions: int | None = None
    predicates: tuple[str, ...] = ()
    days: tuple = ()


@dataclass(frozen=True)
class ConnectionOptions:
    connection_string: str = field(repr=False)
    query: str
    datasource_type: str
    user_name: str | None = None
    password: str | None = field(default=None, repr=False)
    batch_size: int = DEFAULT_BATCH_SIZE
    split: Split | None = None
    jdbc: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        if self.datasource_type not in DATASOURCE_TYPES:
            raise ExtractionError("not_implemented", f"Datasource {self.datasource_type} is not supported")
        if self.batch_size < 1:
            raise ExtractionError("data", f"batch_size must be positive, got {self.batch_size}")

    @property
    def reads_session_tables(self) -> bool:
        return self.connection_string == SESSION_TABLES

    def with_split(self, split: Split) -> ConnectionOptions:
        return replace(self, split=split)


@dataclass(frozen=True)
class ExtractOptions:
    base_dir: str
    table_dir: str
    log_dir: str
    total_size: int
    prefix: str | None = None
    encryption_key: str | None = field(default=None, repr=False)
    batch_size: int = DEFAULT_BATCH_SIZE
    order_by: tuple[str, ...] = ()  # column names, or as in SQL: "total DESC NULLS FIRST"
    dir_columns: tuple[str, ...] = ()
    empty_policy: str = "file"  # "file": one part without rows; "none": no part at all
    max_write_tasks: int = 20_000

    def __post_init__(self):
        if self.empty_policy not in ("file", "none"):
            raise ExtractionError("data", f"unknown empty_policy {self.empty_policy!r}")
        if self.batch_size < 1:
            raise ExtractionError("data", f"batch_size must be positive, got {self.batch_size}")

    @property
    def rows_per_part(self) -> int:
        return self.batch_size * BATCHES_PER_PART
