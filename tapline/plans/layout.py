"""Which rows go to which part: exact cuts every ``chunk`` rows of a sorted result, without one task seeing all rows.

The part of a row follows from its rank in the order key. No row is ranked by a global window. Instead

1. a sample of the order key gives splits that cut the keys into many buckets of about the same size;
2. one pass over the key columns counts the rows of each bucket (combined before the shuffle), which gives the exact
   rank of each bucket's first row and the few buckets that hold a task's first row; if these hold too large a share of
   all keys, they, and only they, are split again;
3. the distinct keys in those buckets, and only they, are counted, shuffled and ranked within their bucket;
4. every row finds its write task by a binary search of its key among the cuts, which is a few code-generated
   comparisons, and the full rows are shuffled once.

Splits and cuts are constants of the plans, so a lost executor's work comes out the same when it is done again.
A write task holds whole parts, in order, so a file limit of ``chunk`` rows cuts them exactly.

Keys need not be unique. Only where a cut falls among rows of one key are these rows ranked again, in the same way, by two
hashes of the whole row. Where it falls among rows that are the same in every column, one of them stands for all: each task
gets a copy with the number of times it has to be written, so a row that a third of all rows repeat is cut like any other.
"""

from __future__ import annotations

import bisect
import itertools
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tapline.errors import ExtractionError

# Below this many rows per task, more tasks than cores bring nothing.
ROWS_PER_TASK = 500_000

# Buckets per write task, their bounds, and sampled keys per bucket.
BUCKETS_PER_TASK, MIN_BUCKETS, MAX_BUCKETS, SAMPLES_PER_BUCKET = 16, 64, 20_000, 32

# So many keys are ranked without cutting them into buckets first; the most times that wanted buckets are split again.
RANK_ROWS, ROUNDS = 1_000_000, 8

# Copies of a repeated row that are made at a time.
_COPIES = 10_000

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ORDERABLE = (
    *_INTEGRAL, T.DecimalType, T.FloatType, T.DoubleType, T.StringType,
    T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType,
)

_ORDER = re.compile(r"^(?P<name>.*?)(?:\s+(?P<way>asc|desc))?(?:\s+nulls\s+(?P<nulls>first|last))?$", re.IGNORECASE | re.DOTALL)


@dataclass(frozen=True)
class Order:
    """One column of an order key. Nulls come first going up and last going down, unless said otherwise."""

    name: str
    down: bool = False
    nulls_last: bool = False

    @classmethod
    def of(cls, text: str | Order, columns: Sequence[str]) -> Order:
        """From a column name, or a name followed by ASC or DESC and NULLS FIRST or LAST as in SQL."""
        if isinstance(text, Order) or text in columns:
            return text if isinstance(text, Order) else cls(text)
        found = _ORDER.match(text.strip())
        down = (found["way"] or "").lower() == "desc"
        return cls(found["name"].strip("`"), down, found["nulls"].lower() == "last" if found["nulls"] else down)

    @property
    def column(self) -> Column:
        return F.col("`" + self.name.replace("`", "``") + "`")

    @property
    def sorted(self) -> Column:
        way = ("desc" if self.down else "asc") + ("_nulls_last" if self.nulls_last else "_nulls_first")
        return getattr(self.column, way)()


@dataclass(frozen=True)
class Folder:
    """One output folder: the values of its directory columns and its rows."""

    values: tuple[str, ...]
    rows: int


@dataclass(frozen=True)
class Cut:
    """The first row of a write task: its key, and hashes of it where the cut falls among rows of that key."""

    key: tuple[str, ...]
    hashes: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Repeated:
    """Rows that are the same in every column and lie in several tasks: how many go to which one."""

    hashes: tuple[str, ...]
    copies: tuple[tuple[int, int], ...]


@dataclass(frozen=True)
class Layout:
    folders: list[Folder]
    chunk: int
    cuts: list[Cut]  # of write tasks 1..
    rows: int
    repeated: list[Repeated] = field(default_factory=list)

    @property
    def tasks(self) -> int:
        return len(self.cuts) + 1


def _ntz_micros(column: Column) -> Column:
    day = F.unix_date(column.cast("date")).cast("long")
    minutes = day * 1440 + F.hour(column) * 60 + F.minute(column)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), column) * 1_000_000).cast("long")


def _key_columns(order: Order, kind: T.DataType) -> list[tuple[Column, T.DataType]]:
    """A mark for nulls, and the column in a form that sorts upwards as asked and whose text reads back as the same value."""
    column, value, down = order.column, order.column, order.down
    if not isinstance(kind, _ORDERABLE):
        raise ExtractionError("data", f"cannot order by column {order.name} of type {kind.simpleString()}")
    mark = F.lit(2)
    if isinstance(kind, T.TimestampType):
        value, kind = F.unix_micros(column), T.LongType()
    elif isinstance(kind, T.BinaryType):
        value, kind = F.hex(column), T.StringType()
    elif down and isinstance(kind, T.TimestampNTZType):
        value, kind = _ntz_micros(column), T.LongType()
    elif down and isinstance(kind, T.DateType):
        value, kind = F.unix_date(column), T.IntegerType()
    elif down and isinstance(kind, T.BooleanType):
        value, kind = column.cast("int"), T.IntegerType()
    elif down and isinstance(kind, T.StringType):
        value = F.hex(column.cast("binary"))
    if down and isinstance(kind, T.StringType):
        # Digits turned round, and an end above all of them: what is longer comes before what it starts with.
        value = F.concat(F.translate(value, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("Z"))
    elif down and isinstance(kind, _INTEGRAL):
        value = F.bitwise_not(value)
    elif down:
        value = -value
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            # NaN is above all numbers.
            mark = F.when(F.isnan(column), 1).otherwise(2)
            value = F.when(F.isnan(column), F.lit(0.0)).otherwise(value).cast(kind)
    zero = {T.StringType: "", T.BooleanType: False}.get(type(kind), 0)
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        zero = "1970-01-01"
    mark = F.when(column.isNull(), 3 if order.nulls_last else 0).otherwise(mark)
    return [(mark, T.IntegerType()), (F.coalesce(value, F.lit(zero).cast(kind)), kind)]


def _row_hashes(df: DataFrame) -> list[Column]:
    """128 bits of the whole row. Maps have no order and zeros have signs, so these are hashed as text."""
    columns = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields]
    told = []
    for c, f in zip(columns, df.schema.fields):
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c.cast("string")
        elif re.search("map<|float|double", f.dataType.simpleString()):
            c = F.to_json(F.struct(c))
        told.append(c)
    return [F.xxhash64(F.lit(seed), *told) for seed in (1, 2)]


class SortKey:
    """The sort key of a DataFrame: columns that compare as asked, under the names 0, 1, .., and literals of them."""

    def __init__(self, df: DataFrame, names: Sequence[str | Order], hashed: bool = False):
        self.orders = [Order.of(n, df.columns) for n in names]
        missing = [o.name for o in self.orders if o.name not in df.columns]
        if missing:
            raise ExtractionError("data", f"order key columns not in the result: {missing}")
        columns = [c for o in self.orders for c in _key_columns(o, df.schema[o.name].dataType)]
        columns += [(c, T.LongType()) for c in _row_hashes(df)] if hashed else []
        self.types = [t for _, t in columns]
        self.names = [str(i) for i in range(len(columns))]
        self.columns = [c.alias(n) for n, (c, _) in zip(self.names, columns)]
        self.sort_columns = [o.sorted for o in self.orders]

    @property
    def value(self) -> Column:
        """The key of a row as one value to compare."""
        return F.struct(*self.columns)

    @property
    def value_type(self) -> T.DataType:
        return T.StructType([T.StructField(n, t) for n, t in zip(self.names, self.types)])

    def literal(self, keys: list[tuple[str, ...]]) -> Column:
        """A constant array of key values; the driver sends their texts once and Spark folds the rest away."""
        texts = T.StructType([T.StructField(n, T.StringType()) for n in self.names])
        rows = [dict(zip(self.names, key)) for key in keys]
        return F.from_json(F.lit(json.dumps(rows)), T.ArrayType(texts)).cast(T.ArrayType(self.value_type))


def _texts(columns: list[Column], prefix: str) -> list[Column]:
    return [c.cast("string").alias(f"{prefix}{i}") for i, c in enumerate(columns)]


def _text_of(row, prefix: str, size: int) -> tuple[str, ...]:
    return tuple(row[f"{prefix}{i}"] for i in range(size))


def with_position(df: DataFrame, name: str, keys: Column, size: int, key: Column) -> DataFrame:
    """Add the number of entries of a sorted constant array that are at most ``key``: a binary search.

    Each step is its own projection, so the search compiles to a straight line of comparisons and the array
    stays one shared constant.
    """
    df = df.withColumn(name, F.lit(0))
    for step in (1 << i for i in reversed(range(size.bit_length()))):
        at = F.col(name)
        df = df.withColumn(name, at + F.when(F.get(keys, at + (step - 1)) <= key, step).otherwise(0))
    return df


def _where(df: DataFrame, condition: Column) -> DataFrame:
    """A filter on found positions that stays above the search.

    Pushed below it, the condition would repeat each step's expression in the next and grow exponentially; Spark
    moves no filter past a projection with a row number in it.
    """
    return df.withColumn("__row", F.monotonically_increasing_id()).where(condition & (F.col("__row") >= 0)).drop("__row")


def _task_starts(folders: list[Folder], chunk: int, total: int, tasks: int) -> list[int]:
    """Ranks at which write tasks 1.. start: part starts, spaced evenly over the rows."""
    starts: list[int] = []
    first, share = 0, 1
    for folder in folders:
        for start in range(first, first + folder.rows, chunk):
            if start and start * tasks >= share * total:
                starts.append(start)
                share = start * tasks // total + 1
        first += folder.rows
    return starts


def _flags(wanted: set[int], size: int) -> Column:
    return F.from_json(F.lit(json.dumps([i in wanted for i in range(size)])), "array<boolean>")


class _Buckets:
    """Ranges of keys with their exact sizes; those that hold a wanted rank are split until they are few keys."""

    def __init__(self, keys: DataFrame, sort: SortKey, ranks: list[int], total: int):
        self.keys, self.sort, self.ranks, self.total = keys, sort, ranks, total
        self.columns = [F.col(f"`{n}`") for n in sort.names]
        self.splits: list[tuple[str, ...]] = []
        self.sizes = [total]
        for _ in range(ROUNDS):
            if sum(self.sizes[i] for i in self.wanted) <= max(RANK_ROWS, total // BUCKETS_PER_TASK) or not self._split():
                break

    @property
    def firsts(self) -> list[int]:
        return list(itertools.accumulate(self.sizes, initial=0))[:-1]

    @property
    def wanted(self) -> set[int]:
        # The bucket of a rank is the last one that starts at or before it (empty ones start where the next one does).
        firsts = self.firsts
        return {bisect.bisect_right(firsts, rank) - 1 for rank in self.ranks}

    def rows(self) -> DataFrame:
        """The keys of the wanted buckets, with their bucket."""
        if not self.splits:
            return self.keys.withColumn("bucket", F.lit(0))
        placed = with_position(self.keys, "bucket", self.sort.literal(self.splits), len(self.splits), F.struct(*self.columns))
        return _where(placed, F.get(_flags(self.wanted, len(self.sizes)), F.col("bucket")))

    def _split(self) -> bool:
        """Cut the wanted buckets by a sample of their keys; whether that gave any new border."""
        wanted = self.wanted
        inside = sum(self.sizes[i] for i in wanted)
        buckets = max(MIN_BUCKETS, min(max(MAX_BUCKETS, len(wanted)), BUCKETS_PER_TASK * (len(self.ranks) + 1)))
        fraction = min(1.0, buckets * SAMPLES_PER_BUCKET / inside)
        rows = self.rows()
        sampled = rows if fraction == 1.0 else rows.sample(fraction, seed=inside)
        found = sampled.orderBy("bucket", *self.columns).select("bucket", *_texts(self.columns, "key")).collect()
        step = max(1, len(found) // buckets)
        new: dict[int, list[tuple[str, ...]]] = {}
        for row in found[step::step]:
            key, own = _text_of(row, "key", len(self.columns)), new.setdefault(row["bucket"], [])
            before = own[-1] if own else self.splits[row["bucket"] - 1] if row["bucket"] else None
            if key != before:
                own.append(key)
        if not any(new.values()):
            return False
        # Buckets without a wanted rank that lie side by side become one, so the list of borders stays short.
        splits, sizes, cut = [], [], []
        for i, size in enumerate(self.sizes):
            if i and not (i not in wanted and i - 1 not in wanted):
                splits.append(self.splits[i - 1])
                sizes.append(0)
            elif not i:
                sizes.append(0)
            if i in wanted:
                cut.append(len(sizes) - 1)
                for key in new.get(i, []):
                    splits.append(key)
                    sizes.append(0)
                    cut.append(len(sizes) - 1)
            else:
                sizes[-1] += size
        placed = with_position(self.keys, "bucket", self.sort.literal(splits), len(splits), F.struct(*self.columns))
        if len(cut) < len(sizes):
            placed = _where(placed, F.get(_flags(set(cut), len(sizes)), F.col("bucket")))
        for row in placed.groupBy("bucket").count().collect():
            sizes[row["bucket"]] = row["count"]
        self.splits, self.sizes = splits, sizes
        return True


def _at_ranks(keys: DataFrame, sort: SortKey, ranks: list[int], total: int) -> list[tuple[tuple[str, ...], int, int]]:
    """For each of the sorted ranks the key there as texts, the rank of the first row of that key, and its rows."""
    buckets = _Buckets(keys, sort, ranks, total)
    columns = buckets.columns
    first = F.from_json(F.lit(json.dumps(buckets.firsts)), "array<bigint>")
    counted = buckets.rows().groupBy("bucket", *columns).count()
    before = Window.partitionBy("bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("over", F.get(first, F.col("bucket")) + F.sum("count").over(before))
    told = F.from_json(F.lit(json.dumps(ranks)), "array<bigint>")
    # How many wanted ranks lie before the end of this key, and before its start.
    placed = with_position(ranked, "n", told, len(ranks), F.col("over") - 1)
    held = _where(placed, (F.col("n") > 0) & (F.get(told, F.col("n") - 1) >= F.col("over") - F.col("count")))
    found = sorted(held.select("over", "count", *_texts(columns, "key")).collect(), key=lambda r: r["over"])
    ends = [r["over"] for r in found]
    out = []
    for rank in ranks:
        i = bisect.bisect_right(ends, rank)
        if i == len(found) or ends[i] - found[i]["count"] > rank:
            raise ExtractionError("data", "the result changed between reads: write it to a table first (stage=True)")
        out.append((_text_of(found[i], "key", len(columns)), ends[i] - found[i]["count"], found[i]["count"]))
    return out


def _among(df: DataFrame, sort: SortKey, keys: list[tuple[str, ...]]) -> DataFrame:
    """The rows whose key is one of these."""
    told = sort.literal(keys)
    placed = with_position(df.withColumn("__key", sort.value), "__at", told, len(keys), F.col("__key"))
    return _where(placed, (F.col("__at") > 0) & (F.get(told, F.col("__at") - 1) == F.col("__key"))).drop("__key", "__at")


def _cuts(df: DataFrame, names: Sequence[str | Order], starts: list[int], total: int) -> tuple[list[Cut], list[Repeated]]:
    """The first rows of write tasks 1.. and the equal rows that several tasks share."""
    sort = SortKey(df, names)
    keys = _at_ranks(df.select(*sort.columns), sort, starts, total)
    if all(first == start for start, (_, first, _) in zip(starts, keys)):
        return [Cut(key) for key, _, _ in keys], []
    # Rows of the keys that are cut, ranked among themselves; `before` is the rank there of a key's first row.
    tied = {first: (key, count) for start, (key, first, count) in zip(starts, keys) if first != start}
    before, rows = {}, 0
    for first in sorted(tied):
        before[first] = rows
        rows += tied[first][1]
    full = SortKey(df, names, hashed=True)
    inside = _among(df, sort, [tied[first][0] for first in sorted(tied)])
    asked = [(start, first) for start, (_, first, _) in zip(starts, keys) if first != start]
    told = _at_ranks(inside.select(*full.columns), full, [before[f] + s - f for s, f in asked], rows)
    ranked = {s: (key, f + found - before[f], n) for (s, f), (key, found, n) in zip(asked, told)}
    cuts, shared = [], {}
    for start, (key, first, _) in zip(starts, keys):
        hashes = None
        if start in ranked:
            whole, first, n = ranked[start]
            hashes = whole[len(sort.names):]
            if first != start:
                shared[first] = (hashes, n)
        cuts.append(Cut(key, hashes))
    repeated = []
    for first, (hashes, n) in shared.items():
        bounds = [first, *(s for s in starts if first < s < first + n), first + n]
        task = bisect.bisect_right(starts, first)
        repeated.append(Repeated(hashes, tuple((task + i, b - a) for i, (a, b) in enumerate(itertools.pairwise(bounds)))))
    return cuts, repeated


def plan_layout(
    df: DataFrame, dir_columns: tuple[str, ...], order_by: Sequence[str | Order], chunk: int, max_tasks: int
) -> Layout:
    """Folders with their row counts, and the cuts of the write tasks. Reads the key columns only, where keys do not repeat."""
    spark = df.sparkSession
    if dir_columns:
        counted = df.groupBy(*dir_columns).count().orderBy(*dir_columns).collect()
        folders = [Folder(tuple(r[c] for c in dir_columns), r["count"]) for r in counted]
    else:
        folders = [Folder((), df.count())]
    total = sum(f.rows for f in folders)
    if total == 0:
        return Layout([], chunk, [], 0)
    parts = sum(-(-f.rows // chunk) for f in folders)
    tasks = min(parts, max_tasks, max(spark.sparkContext.defaultParallelism, -(-total // ROWS_PER_TASK)))
    starts = _task_starts(folders, chunk, total, tasks)
    cuts, repeated = _cuts(df, (*dir_columns, *order_by), starts, total) if starts else ([], [])
    return Layout(folders, chunk, cuts, total, repeated)


def _placed(df: DataFrame, names: Sequence[str | Order], layout: Layout) -> DataFrame:
    """The rows with their write task, and how many times each is to be written."""
    once = F.lit(1).cast("long")
    if not layout.cuts:
        return df.withColumn("__task", F.lit(0)).withColumn("__copies", once)
    sort = SortKey(df, names)
    tied = list(dict.fromkeys(c.key for c in layout.cuts if c.hashes))
    if not tied:
        keyed = df.withColumn("__key", sort.value)
        told = sort.literal([c.key for c in layout.cuts])
    else:
        # Hashes matter, and are taken, only for rows of the keys that are cut; a cut at the start of a key has the least ones.
        keyed = with_position(df.withColumn("__own", sort.value), "__at", sort.literal(tied), len(tied), F.col("__own"))
        cut = (F.col("__at") > 0) & (F.get(sort.literal(tied), F.col("__at") - 1) == F.col("__own"))
        keyed = keyed.withColumn("__cut", cut)
        full = SortKey(df, names, hashed=True)
        hashes = [F.when(F.col("__cut"), c).otherwise(0) for c in _row_hashes(df)]
        names_ = full.names[len(sort.names):]
        keyed = keyed.withColumn("__hashes", F.struct(*(c.alias(n) for c, n in zip(hashes, names_))))
        keyed = keyed.withColumn("__key", F.struct(
            *(F.col("__own")[n].alias(n) for n in sort.names), *(F.col("__hashes")[n].alias(n) for n in names_)))
        least = (str(-(1 << 63)),) * 2
        told = full.literal([c.key + (c.hashes or least) for c in layout.cuts])
    placed = with_position(keyed, "__task", told, len(layout.cuts), F.col("__key")).withColumn("__copies", once)
    if layout.repeated:
        a, b = (F.col("__key")[n] for n in names_)
        known = F.from_json(F.lit(json.dumps([",".join(r.hashes) for r in layout.repeated])), "array<string>")
        placed = placed.withColumn("__same", F.when(F.col("__cut"), F.array_position(known, F.concat_ws(",", a, b))).otherwise(0))
        copies = df.sparkSession.createDataFrame(
            [(i, task, n) for i, r in enumerate(layout.repeated, 1) for task, n in r.copies],
            "__same long, __task int, __copies long")
        lone = _where(placed, F.col("__same") == 0)
        stand = _where(placed, F.col("__same") > 0).dropDuplicates(["__same"]).drop("__task", "__copies")
        placed = lone.unionByName(stand.join(F.broadcast(copies), "__same").select(*lone.columns))
    return placed.select(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns), "__task", "__copies")


def _copied(df: DataFrame) -> DataFrame:
    """Each row as many times as it is to be written, a bounded number of numbers at a time."""
    of_block = F.least(F.lit(_COPIES), F.col("__copies") - F.col("__block") * _COPIES)
    df = df.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / _COPIES))))
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), of_block))).drop("__block", "__copy")


def arrange(df: DataFrame, dir_columns: tuple[str, ...], order_by: Sequence[str | Order], layout: Layout) -> DataFrame:
    """The rows in one partition per write task, sorted: the only shuffle of full rows."""
    names = (*dir_columns, *order_by)
    dealt = _placed(df, names, layout).repartitionById(layout.tasks, F.col("__task"))
    if layout.repeated:
        dealt = _copied(dealt)
    return dealt.sortWithinPartitions(*SortKey(df, names).sort_columns).drop("__task", "__copies")


def skip_rows(df: DataFrame, order_by: Sequence[str | Order], count: int) -> DataFrame:
    """The sorted result without its first ``count`` rows: OFFSET, with no task that sees all rows. Ties keep one order.

    The key of the first row to keep is found from the key columns alone; the rest is a filter on it.
    """
    columns = df.columns
    sort = SortKey(df, order_by)
    if count > 0:
        total = df.count()
        if count >= total:
            return df.limit(0)
        cuts, repeated = _cuts(df, order_by, [count], total)
        kept = _where(_placed(df, order_by, Layout([], total, cuts, total, repeated)), F.col("__task") > 0)
        df = (_copied(kept) if repeated else kept).select(*(F.col("`" + c.replace("`", "``") + "`") for c in columns))
    return df.orderBy(*sort.sort_columns)
