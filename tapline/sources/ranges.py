"""Ranges of a key that hold about equally many rows, found by counting on the database; and reads that go on where they stopped.

The database counts the rows of some strides of the key in one statement. Strides with too many rows are cut again until
none holds more than a quarter of what a range should; a range ends at the border nearest to its share. Only counts come back. Values that lie
close together, or one value far off, so do not matter; rows of one and the same value cannot be parted by a range.
"""

from __future__ import annotations

import bisect
import datetime as dt
import decimal
import hashlib
import itertools
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from tapline.errors import ExtractionError
from tapline.operators.store import Store, at_once

# Strides that one statement counts, and statements at most.
STRIDES, STATEMENTS = 128, 12
# Rows that one range is given where the caller does not say how many ranges there are.
ROWS_PER_RANGE = 500_000
# The name of the list of ranges in a folder of staged ones.
PLAN = "ranges.json"

# Types of keys whose values lie on a line.
COUNTED = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType,
    T.TimestampNTZType,
)

_EPOCH = dt.datetime(1970, 1, 1)
_MICROSECOND = dt.timedelta(microseconds=1)


def _number(value):
    """A key value as a number."""
    if isinstance(value, dt.datetime):
        return (value.replace(tzinfo=None) - _EPOCH) // _MICROSECOND
    return value.toordinal() if isinstance(value, dt.date) else value


def literal_writer(spark: SparkSession, dialect, kind: T.DataType) -> Callable[[object], str]:
    """From such a number to a literal in the words of the database."""
    sql = spark._jvm.java.sql

    def write(number) -> str:
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return dialect.compileValue(sql.Timestamp.valueOf(str(_EPOCH + number * _MICROSECOND)))
        if isinstance(kind, T.DateType):
            return dialect.compileValue(sql.Date.valueOf(dt.date.fromordinal(number).isoformat()))
        return f"{number:f}" if isinstance(number, decimal.Decimal) else repr(number)

    return write


def dialect_of(spark: SparkSession, url: str):
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)


def date_literals(spark: SparkSession, url: str, days) -> list[str]:
    """Dates in order, as the database writes them."""
    write = literal_writer(spark, dialect_of(spark, url), T.DateType())
    return [write(day) for day in sorted({day.toordinal() for day in days})]


def _strides(low, high, pieces: int) -> list:
    """Borders that cut [low, high) into about so many pieces; none where no value lies between."""
    whole = isinstance(low, int)
    if whole:
        pieces = min(pieces, high - low)
        return sorted({low + (high - low) * i // pieces for i in range(1, pieces)} - {low})
    step = (high - low) / pieces
    return sorted({low + step * i for i in range(1, pieces)} - {low, high})


def even_cuts(ask: Callable[[list[str]], tuple], name: str, literal: Callable, ranges: Callable[[int], int]) -> list[str]:
    """Literals that cut the key into ranges of about equally many rows. ``ask`` gives the one row of some aggregates."""
    low, high, rows = ask([f"MIN({name})", f"MAX({name})", f"COUNT({name})"])
    if low is None or low == high:
        return []
    most = max(1.0, rows / max(1, ranges(rows)))
    low, high = _number(low), _number(high)
    pieces = [(low, high + 1, rows)]
    for _ in range(STATEMENTS):
        # The last piece has no end of its own, so that a fraction above the greatest value does not matter.
        heavy = [i for i, (a, b, n) in enumerate(pieces) if n > most / 4 and _strides(a, b, 2)]
        if not heavy:
            break
        heavy = sorted(sorted(heavy, key=lambda i: -pieces[i][2])[:STRIDES // 2])
        cut = {i: [pieces[i][0], *_strides(pieces[i][0], pieces[i][1], max(2, STRIDES // len(heavy)))] for i in heavy}
        tests = []
        for i in heavy:
            for a, b in zip(cut[i], [*cut[i][1:], pieces[i][1] if i + 1 < len(pieces) else None]):
                over = f"{name} >= {literal(a)}" + (f" AND {name} < {literal(b)}" if b is not None else "")
                tests.append(f"SUM(CASE WHEN {over} THEN 1 ELSE 0 END)")
        counts = iter(ask(tests))
        pieces = [p for i, piece in enumerate(pieces) for p in (
            [(a, b, int(next(counts))) for a, b in zip(cut[i], [*cut[i][1:], piece[1]])] if i in cut else [piece])]
    # The border of two pieces that is nearest to each share of the rows.
    before = list(itertools.accumulate((n for _, _, n in pieces), initial=0))
    cuts: list[int] = []
    for share in range(1, round(rows / most)):
        i = bisect.bisect_left(before, share * most)
        i -= i > 0 and before[i] - share * most > share * most - before[i - 1]
        if (cuts[-1] if cuts else 0) < i < len(pieces) and before[i] > before[cuts[-1] if cuts else 0]:
            cuts.append(i)
    return [literal(pieces[i][0]) for i in cuts]


def staged_ranges(spark: SparkSession, read_range: Callable[[str], DataFrame], ranges: Callable[[], tuple[str, ...]],
                  said: str, folder: str) -> DataFrame:
    """Each range written to a folder of its own, by a job of its own; ranges that an earlier run finished are not read again.

    ``said`` is what the rows depend on; a folder of other rows is refused. The ranges are written down before the first is
    read, and stay as they are. A range that fails does not keep the others from being finished; its error is raised after.
    Ranges are read at different times, so the rows are those of one moment only if the source does not change meanwhile.
    """
    store, plan = Store(spark, folder), f"{folder}/{PLAN}"
    mark = hashlib.sha256(said.encode()).hexdigest()
    store.make_folder(folder)
    if store.exists(plan):
        known = json.loads("".join(r.value for r in spark.read.text(plan, wholetext=True).collect()))
        if known["rows"] != mark:
            raise ExtractionError("data", f"{folder} holds ranges of another query")
    else:
        known = {"rows": mark, "ranges": list(ranges())}
        store.write_lines(plan, [json.dumps(known)])

    def write(numbered: tuple[int, str]) -> Exception | None:
        number, predicate = numbered
        target = f"{folder}/range-{number:06d}"
        # Spark leaves this marker once all files of a write are in place.
        if not store.exists(f"{target}/_SUCCESS"):
            try:
                read_range(predicate).write.mode("overwrite").parquet(target)
            except Exception as err:  # raised below, after the other ranges
                return err
        return None

    failed = [err for err in at_once(write, enumerate(known["ranges"])) if err is not None]
    if failed:
        raise failed[0]
    schema = read_range(known["ranges"][0]).schema
    return spark.read.schema(schema).parquet(*(f"{folder}/range-{i:06d}" for i in range(len(known["ranges"]))))
