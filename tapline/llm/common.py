"""What the operators share: tables, staging, column names and views of whole texts in batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapline.session import scratch_folder

# Bytes of text that a task looks at together; a longer text is looked at alone.
CHUNK_BYTES = 1 << 20
# Words of the contracts are runs of anything but these six ASCII characters.
SPACES = r"[\x20\x09-\x0D]+"


# Applications whose Python workers have been sent this package.
_SENT: set[str] = set()


def send_package(df: DataFrame) -> None:
    """Have Spark give this package to all Python workers, once in an application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SENT:
        # The driver's file server hands the archive out as long as the application runs.
        folder = tempfile.mkdtemp(prefix="tapline-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = Path(__file__).resolve().parents[2]
        context.addPyFile(shutil.make_archive(f"{folder}/tapline", "zip", root, "tapline"))
        _SENT.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark's setting that removes the shuffle files of a query once it is over.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the cluster's shared scratch folder and read again: lineage ends there.

    Nothing reads the shuffle files of that write again, so they go with it and do not wait for the driver's garbage
    collection. The session's setting is as before afterwards.
    """
    spark = df.sparkSession
    folder, before = scratch_folder(spark, label), spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def drop_staged(df: DataFrame) -> None:
    """Remove the folder of a staged table that a later one has replaced."""
    jvm = df.sparkSession._jvm
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def with_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add result columns; one of the input with the same name (in any case) gives way."""
    taken = {name.lower() for name in columns}
    return df.select(*(df[f"`{c}`"] for c in df.columns if c.lower() not in taken),
                     *(column.alias(name) for name, column in columns.items()))


def row_key(*columns) -> Column:
    """What stands for a row: rows that agree in these columns count as one."""
    return F.xxhash64(*columns)


def crc_of_id(column) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def blocks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about `limit` bytes together, never fewer than one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts or bytes, and where each row starts (one entry more than rows); null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else (
        np.zeros(1, np.int64))
    view = np.frombuffer(data, np.uint8)[starts[0]:starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return view, starts - starts[0]


def strings_of(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each run of `sizes` hashes the 64 bits that are set in over half of them; an empty run has none.

    Bits are counted in byte lanes, eight to a word, over at most 255 hashes at a time.
    """
    out = np.zeros(len(sizes), np.uint64)
    rows = np.flatnonzero(sizes)
    if not len(rows):
        return out
    size = sizes[rows]
    begin = np.cumsum(size) - size
    parts = -(-size // 255)
    first = np.cumsum(parts) - parts
    cut = np.repeat(begin, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    weight = np.uint64(1) << np.arange(64, dtype=np.uint64)
    ones = np.uint64(0x0101010101010101)
    counts = np.empty((len(cut), 64), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & ones, cut)
        # Byte j of a word counts bit 8 j + k.
        counts[:, k::8] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8)
    total = np.add.reduceat(counts, first, axis=0)
    out[rows] = ((2 * total > size[:, None]) * weight).sum(axis=1, dtype=np.uint64)
    return out


_BASE, _ODD = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift in (30, 27):
        x = (x ^ (x >> np.uint64(shift))) * _ODD
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, np.uint64)))
                 for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of each text, words being parted by blanks, and the number of words of each text."""
    return word_hashes_of(*bytes_of(column))


def word_hashes_of(view: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of all bytes of the texts and their starts (one entry more than texts).

    The hash is a polynomial over the word's bytes, read from running sums over all texts at once, and mixed.
    """
    if not len(view):
        return np.zeros(0, np.uint64), np.zeros(len(starts) - 1, np.int64)
    inside = view != 0x20
    some = starts[1:] > starts[:-1]
    fresh, over = np.append(True, ~inside[:-1]), np.append(~inside[1:], True)
    fresh[starts[:-1][some]] = True
    over[starts[1:][some] - 1] = True
    begin, end = np.flatnonzero(inside & fresh), np.flatnonzero(inside & over) + 1
    power, inverse = _powers(max(CHUNK_BYTES, 1 << (len(view) - 1).bit_length()))
    total = np.append(np.uint64(0), np.cumsum(_byte_values()[view] * power[:len(view)]))
    return _mixed((total[end] - total[begin]) * inverse[begin]), np.diff(np.searchsorted(begin, starts))
