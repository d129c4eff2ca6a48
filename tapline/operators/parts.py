"""The Parquet sink: numbered parts of a fixed row count, put in place only when all of them are written."""

from __future__ import annotations

import re
import time
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapline.errors import ExtractionError
from tapline.operators import envelope, manifest, paths
from tapline.operators.store import Store, at_once
from tapline.options import ExtractOptions
from tapline.plans.layout import Layout, arrange, plan_layout

# Writer task and file number within it, as Spark puts them in a file name.
_SPARK_FILE = re.compile(r"^part-([0-9]+)-.*[.-]c([0-9]+)\.")


@dataclass(frozen=True)
class Staged:
    """A written file that is not in place yet; ``order`` sorts the files of a folder."""

    folder: str
    order: tuple[int, int]
    rows: int
    uri: str
    written_millis: int
    digest: bytes | None = None  # of the header of an encrypted part


@dataclass(frozen=True)
class Result:
    rows: int
    parts: int
    manifests: list[str]
    cut: dict[str, int] = field(default_factory=dict)  # values of each column that max_text_len cut


def _write_plain(df: DataFrame, options: ExtractOptions, staging: str) -> None:
    writer = (
        df.write.mode("overwrite")
        .option("compression", "snappy")
        .option("parquet.writer.version", "PARQUET_1_0")
        .option("maxRecordsPerFile", options.rows_per_part)
    )
    if options.dir_columns:
        writer = writer.partitionBy(*options.dir_columns)
    writer.parquet(staging)


def _staged_plain(spark: SparkSession, store: Store, staging: str, schema) -> Iterator[Staged]:
    """The staged files with their row counts, which come from the file footers: no column is read."""
    counter = spark.newSession()
    # A task does little more than open files here, so it gets many of them.
    counter.conf.set("spark.sql.files.maxPartitionBytes", "16g")
    files = counter.read.schema(schema).option("recursiveFileLookup", "true").parquet(staging)
    uri, written = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    counted = files.groupBy(uri.alias("uri"), F.unix_millis(written).alias("written_millis")).count().collect()
    found = [(unquote(_below(r["uri"], staging)), r["count"], r["written_millis"]) for r in counted]
    if not found:
        # Files without rows do not show up above; an empty result has at least one.
        found = [(name, 0, int(time.time() * 1000)) for name in store.names(staging)]
    for below, rows, millis in found:
        folder, _, name = below.rpartition("/")
        match = _SPARK_FILE.match(name)
        if match:
            yield Staged(folder, (int(match[1]), int(match[2])), rows, f"{staging}/{below}", millis)


def _below(uri: str, staging: str) -> str:
    return uri.partition(staging.rsplit("/", 1)[-1] + "/")[2]


def _check(staged: dict[str, list[Staged]], layout: Layout, options: ExtractOptions) -> None:
    """Every part but the last of a folder must be full; anything else means that two reads gave different rows."""
    for folder in layout.folders:
        name = paths.folder_name(options.dir_columns, folder.values)
        rows = [s.rows for s in staged.get(name, [])]
        full, rest = divmod(folder.rows, layout.chunk)
        if rows != [layout.chunk] * full + ([rest] if rest else []):
            raise ExtractionError(
                "data", f"parts of {name or options.table_dir} do not hold {layout.chunk} rows each: "
                "the result changed between reads, write it to a table first (stage=True)"
            )


def write_parts(df: DataFrame, options: ExtractOptions) -> Result:
    """Write the rows of ``df`` as numbered parts and return their total.

    With an order key, part ``i`` of a folder holds rows ``i * rows_per_part`` and following of the sorted result.
    Without one, rows stay in the partitions they come in, and only the last part of each partition may be short;
    a result of one partition is thus cut exactly, in the order of the source.
    """
    spark = df.sparkSession
    if len(set(df.columns)) != len(df.columns):
        raise ExtractionError("data", f"duplicate column names in the result: {df.columns}")
    for c in options.dir_columns:
        if df.schema[c].dataType.typeName() == "string":
            # An empty text has the folder of nulls.
            df = df.withColumn(c, F.nullif(F.col("`" + c.replace("`", "``") + "`"), F.lit("")))
    base = paths.table_uri(options)
    store = Store(spark, base)
    store.make_folder(base)
    staging = f"{store.absolute(base)}/.writing-{uuid.uuid4().hex}"
    try:
        layout = sealing = None
        if options.order_by:
            layout = plan_layout(
                df, options.dir_columns, options.order_by, options.rows_per_part, options.max_write_tasks
            )
            if layout.rows:
                df = arrange(df, options.dir_columns, options.order_by, layout)
        elif options.dir_columns:
            # One task per folder, except that AQE splits large folders and joins small ones.
            df = df.hint("rebalance", *[F.col(c) for c in options.dir_columns])
        if options.encryption_key:
            sealing = envelope.new_sealing(spark, options.encryption_key)
            found = envelope.write_encrypted(df, options, staging, sealing)
            written = [Staged(f, (t, i), n, u, ms, d) for f, t, i, n, u, ms, d in found]
        else:
            _write_plain(df, options, staging)
            written = list(_staged_plain(spark, store, staging, df.drop(*options.dir_columns).schema))
        staged = _in_order(written, options)
        if layout:
            _check(staged, layout, options)
        return _commit(spark, store, base, staged, options, sealing)
    finally:
        store.delete(staging)


def _in_order(written: list[Staged], options: ExtractOptions) -> dict[str, list[Staged]]:
    """Files per folder in part order. Files without rows are dropped, but for one that the empty policy keeps."""
    kept = [s for s in written if s.rows]
    if not kept and options.empty_policy == "file" and not options.dir_columns:
        kept = sorted(written, key=lambda s: s.order)[:1]
    by_folder: dict[str, list[Staged]] = defaultdict(list)
    for s in sorted(kept, key=lambda s: (s.folder, s.order)):
        by_folder[s.folder].append(s)
    if not options.dir_columns:
        by_folder.setdefault("", [])
    return by_folder


def _commit(spark: SparkSession, store: Store, base: str, staged: dict[str, list[Staged]], options, sealing) -> Result:
    """Move the parts in place, remove parts of an earlier run that have no successor, then write seals and manifests."""
    pattern = paths.part_name_pattern(options)
    folders = {folder: f"{base}/{folder}" if folder else base for folder in staged}

    def left_over(folder: str) -> list[str]:
        target = folders[folder]
        store.make_folder(target)
        numbers = [(name, pattern.match(name)) for name in store.names(target)]
        return [f"{target}/{name}" for name, m in numbers if m and int(m[1]) >= len(staged[folder])]

    stale = [uri for found in at_once(left_over, staged) for uri in found]
    moves = [
        (s.uri, f"{folders[folder]}/{paths.part_name(options, i)}")
        for folder, files in staged.items() for i, s in enumerate(files)
    ]
    at_once(lambda move: store.move(*move), moves)
    at_once(store.delete, stale)

    def seal(folder: str) -> None:
        uri = envelope.seal_uri(folders[folder], options.prefix or "")
        store.write_lines(uri, [sealing.seal(s.digest for s in staged[folder])])

    if sealing:
        at_once(seal, staged)
    log_store = Store(spark, options.log_dir)
    log_store.make_folder(options.log_dir)

    def write_manifest(folder: str) -> str:
        table_dir = f"{options.table_dir}/{folder}" if folder else options.table_dir
        path = paths.log_path(options.log_dir, table_dir)
        log_store.write_lines(path, manifest.lines(table_dir, options.total_size, staged[folder]))
        return path

    manifests = at_once(write_manifest, staged)
    return Result(
        sum(s.rows for files in staged.values() for s in files), sum(map(len, staged.values())), manifests
    )
