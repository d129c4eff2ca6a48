"""The prefix trie of conversations: splitter paths as a skeleton, sorted shards for everything else.

A conversation is a path of turns from a root without text; conversations with the same first turns share nodes. A run of
nodes with the same members is one edge, so a path is a short list of edges however long the conversation is: k edges need
conversations of k^2/2 turns in all. Paths are range-partitioned at sampled splitters (path and conversation, so that equal
paths are split too). The sorted splitters, whose prefixes are the skeleton, are broadcast; they are thinned out until they
take no more than `SKELETON_BYTES`. A node that is no prefix of a splitter has all its members in one shard: the shard, read in
order with a stack of open nodes, finishes it. Of a skeleton node each shard gives what it has seen below it; these partial
aggregates are reduced by node, and the skeleton, a small tree, is summed up from its tips on the driver. Member ids of skeleton
nodes travel as joined stretches in order and are digested as they stream by.

What a node is follows from its depth and 128 bits that combine the hashes of its turns and their places, built up along each
conversation in sorted order; a conversation or a first turn that a third of all rows hold is spread over many tasks.

Turns are ordered by number (null first), then role and text; a null role or text is empty. Rows without a conversation id are
left out. Repeated rows are turns of their own, texts of any length are hashed where they are read, columns other than the four
are ignored, and an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapline.llm.common import _BASE, _mixed, drop_staged, send_package, staged, table

# Conversations of a shard and the most shards; sampled paths for each; bytes of splitter paths that are broadcast.
SHARD_ROWS, MAX_SHARDS, SAMPLES, SKELETON_BYTES = 100_000, 100_000, 4, 64 << 20
# Characters of an edge in a path, of a stretch of member ids, and of a text that cuts a range.
EDGE, STRETCH, RANGE_TEXT = 32, 1 << 16, 256
NOTHING = hashlib.sha256(b"").hexdigest()

_SHARD_ROW = ("kind int, key string, conv_id long, n long, parent long, first int, before long, after long, children long, "
              "leaves long, below long, ends string")


def _lanes(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _runs(conv: np.ndarray, last: int | None) -> tuple[np.ndarray, bool]:
    """For each row the place of the first row of its conversation in the batch, and whether the first one goes on."""
    fresh = np.append(True, conv[1:] != conv[:-1])
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(conv)), 0))
    return start, last is not None and conv[0] == last


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, pos, n, a, b, bytes): turns with their place from 0 among the n of the conversation and two hashes of
    role and text. `part` is where the turn was ordered: a conversation's turns are never all in one task by rule."""
    send_package(conversations)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text[0].alias("role"), text[1].alias("text"))
    order = ["conv_id", "turn", "role"]
    spread = rows.repartitionByRange(_lanes(rows), *order, F.substring("text", 1, RANGE_TEXT)).sortWithinPartitions(
        *order, "text")
    hashed = spread.select(
        "conv_id", F.spark_partition_id().alias("part"), *(F.xxhash64(F.lit(seed), "role", "text").alias(n) for seed, n in (
            (1, "a"), (2, "b"))), F.octet_length("text").cast("long").alias("bytes"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            if not len(batch):
                continue
            conv = batch.column(0).to_numpy()
            start, goes_on = _runs(conv, last)
            pos = np.arange(len(conv)) - start + np.where((start == 0) & goes_on, count, 0)
            last, count = conv[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pos), *batch.columns[2:]],
                ["conv_id", "part", "pos", "a", "b", "bytes"])

    turns = staged(hashed.mapInArrow(number, "conv_id long, part int, pos long, a long, b long, bytes long"), "turns")
    sizes = turns.groupBy("conv_id", "part").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy("conv_id")
    sizes = sizes.select(
        "conv_id", "part", F.sum("_n").over(whole).alias("n"),
        F.coalesce(F.sum("_n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return turns.join(sizes, ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("pos") + F.col("_b")).alias("pos"), "n", "a", "b", "bytes")


def _walks(turns: DataFrame) -> DataFrame:
    """(c, depth, bytes, x, y, after): the node that each turn of a path leads to, and the bytes of the path so far."""
    order = ["c", "depth"]
    spread = turns.repartitionByRange(_lanes(turns), *order).sortWithinPartitions(*order).select(
        "c", F.spark_partition_id().alias("part"), "depth", "bytes", "a", "b")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ends = None, (0, 0, 0)
        for batch in batches:
            if not len(batch):
                continue
            conv, depth, size = (batch.column(i).to_numpy() for i in (0, 2, 3))
            start, goes_on = _runs(conv, last)
            first = (start == 0) & goes_on
            place = depth.astype(np.uint64) * np.uint64(_BASE)
            out = []
            for i, end in zip((4, 5), ends):
                sofar = np.bitwise_xor.accumulate(_mixed(batch.column(i).to_numpy().view(np.uint64) ^ place))
                earlier = np.where(start > 0, sofar[start - 1], np.where(first, np.uint64(end), np.uint64(0)))
                out.append(sofar ^ earlier)
            total = np.cumsum(size)
            after = total - np.where(start > 0, total[start - 1], np.where(first, -ends[2], 0))
            last, ends = conv[-1], (int(out[0][-1]), int(out[1][-1]), int(after[-1]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(out[0].view(np.int64)), pa.array(out[1].view(np.int64)), pa.array(after)],
                ["c", "part", "depth", "bytes", "x", "y", "after"])

    parts = staged(spread.mapInArrow(
        walk, "c long, part int, depth int, bytes long, x long, y long, after long"), "walks")
    ends = parts.groupBy("c", "part").agg(*(F.max_by(v, "depth").alias(f"_{v}") for v in ("x", "y", "after")))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("c", "part", F.bit_xor("_x").over(before).alias("_x"), F.bit_xor("_y").over(before).alias("_y"),
                          F.sum("_after").over(before).alias("_after")).where("_after is not null")
    # Only the first conversation of a part can have begun in an earlier one: at most a row for each part.
    return parts.join(F.broadcast(carried), ["c", "part"], "left").select(
        "c", "depth", "bytes", *(F.col(v).bitwiseXOR(F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in ("x", "y")),
        (F.col("after") + F.coalesce("_after", F.lit(0))).alias("after"))


def _splitters(paths: DataFrame, rows: int) -> list[tuple[str, int]]:
    shards = min(MAX_SHARDS, max(_lanes(paths), -(-rows // SHARD_ROWS)))
    fraction = min(1.0, shards * SAMPLES / rows)
    sampled = paths.select("key", "c") if fraction == 1 else paths.select("key", "c").sample(fraction, seed=1)
    found = [tuple(r) for r in sampled.orderBy("key", "c").collect()]
    step = max(1, -(-len(found) // shards))
    found = found[step::step]
    while sum(len(key) for key, _ in found) > SKELETON_BYTES:
        found = found[1::2]
    return found


class _Shard:
    """One pass over the sorted paths of a shard. An open node is a list, its fields named below."""

    KEY, CONV, N, PARENT, FIRST, BEFORE, AFTER, CHILDREN, LEAVES, BELOW, ENDS, SKELETON = range(12)

    def __init__(self, shard: int, splitters: list[tuple[str, int]]):
        self.borders = [splitters[i][0] for i in (shard - 1, shard) if 0 <= i < len(splitters)]
        self.open: list[list] = [["", None, 0, None, 0, 0, 0, 0, 0, 0, None, True]]
        self.path, self.rows, self.stretch = "", [], None

    def add(self, conv: int, path: str, edges: list[dict]) -> None:
        if path != self.path:
            self.stretch = None
            shared = 0
            while shared + 1 < len(self.open) and path.startswith(self.path[:(shared + 1) * EDGE]):
                shared += 1
            while len(self.open) > shared + 1:
                self._close()
            for i, e in enumerate(edges[shared:], shared):
                key = path[:(i + 1) * EDGE]
                self.open.append([
                    key, e["m"], e["n"], edges[i - 1]["m"] if i else None, e["first"], e["before"], e["after"], 0, 0, 0, None,
                    any(b.startswith(key) for b in self.borders)])
            self.path = path
        node = self.open[-1]
        if not node[self.SKELETON]:
            if node[self.ENDS] is None:
                node[self.ENDS] = hashlib.sha256(str(conv).encode())
            else:
                node[self.ENDS].update(f",{conv}".encode())
        elif self.stretch is None or len(self.stretch[11]) > STRETCH:
            self.stretch = [2, node[self.KEY], conv, *[None] * 8, str(conv)]
            self.rows.append(self.stretch)
        else:
            self.stretch[11] += f",{conv}"

    def _close(self) -> None:
        node, over = self.open.pop(), self.open[-1]
        if node[self.SKELETON]:
            # What is above it gets its sums once the parts of all shards are known.
            self.rows.append([1, *node[:self.ENDS], None])
            return
        node[self.LEAVES] += node[self.CHILDREN] == 0
        ends = node[self.ENDS].hexdigest() if node[self.ENDS] else NOTHING
        self.rows.append([0, None, *node[self.CONV:self.ENDS], ends])
        over[self.CHILDREN] += 1
        over[self.LEAVES] += node[self.LEAVES]
        over[self.BELOW] += node[self.BELOW] + (node[self.N] - 1) * (node[self.AFTER] - node[self.BEFORE])

    def finish(self) -> None:
        while len(self.open) > 1:
            self._close()
        self.rows.append([1, *self.open[0][:self.ENDS], None])

    def taken(self) -> pa.RecordBatch:
        # A stretch that may still grow stays.
        kept = [self.stretch] if self.stretch is not None and self.rows and self.rows[-1] is self.stretch else []
        out = self.rows[:len(self.rows) - len(kept)]
        self.rows = kept
        names = [f.split()[0] for f in _SHARD_ROW.split(", ")]
        kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[f.split()[1]] for f in _SHARD_ROW.split(", ")]
        columns = zip(*out) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _shards(paths: DataFrame, splitters: list[tuple[str, int]]) -> DataFrame:
    shared = paths.sparkSession.sparkContext.broadcast(splitters)

    @F.arrow_udf("int")
    def shard_of(key: pa.Array, conv: pa.Array) -> pa.Array:
        borders = shared.value
        return pa.array([bisect.bisect_right(borders, row) for row in zip(key.to_pylist(), conv.to_pylist())], pa.int32())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != at:
                    if shard is not None:
                        shard.finish()
                        shard.stretch = None
                        yield shard.taken()
                    at, shard = row["shard"], _Shard(row["shard"], shared.value)
                shard.add(row["c"], row["key"], row["edges"] or [])
            if shard is not None:
                yield shard.taken()
        if shard is not None:
            shard.finish()
            shard.stretch = None
            yield shard.taken()

    dealt = paths.withColumn("shard", shard_of("key", "c")).repartitionById(len(splitters) + 1, F.col("shard"))
    return staged(dealt.sortWithinPartitions("shard", "key", "c").mapInArrow(scan, _SHARD_ROW), "shards")


def _digests(stretches: DataFrame) -> DataFrame:
    """(key, ends): the digest of the stretches of each node in order, which stream by."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != at:
                    done += [(at, state.hexdigest())] if state else []
                    at, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
            yield pa.RecordBatch.from_pylist([{"key": k, "ends": e} for k, e in done],
                                             pa.schema([("key", pa.string()), ("ends", pa.string())]))
        if state:
            yield pa.RecordBatch.from_pydict({"key": [at], "ends": [state.hexdigest()]})

    return stretches.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends").mapInArrow(
        digest, "key string, ends string")


def _skeleton(shards: DataFrame, least: int, n: int) -> DataFrame:
    """The skeleton's nodes in the columns of finished ones. Their number is bounded by the bytes of the splitters."""
    once = ["conv_id", "n", "parent", "first", "before", "after"]
    rows = shards.where("kind = 1").groupBy("key").agg(
        *(F.first(c).alias(c) for c in once), *(F.sum(c).alias(c) for c in ("children", "leaves", "below"))).collect()
    nodes = {r.key: r.asDict() for r in rows}
    nodes[""] |= {"conv_id": least, "n": n}
    for key in sorted(nodes, key=len, reverse=True):
        node = nodes[key]
        node["leaves"] += node["children"] == 0
        if key:
            over = nodes[key[:-EDGE]]
            over["children"] += 1
            over["leaves"] += node["leaves"]
            over["below"] += node["below"] + (node["n"] - 1) * (node["after"] - node["before"])
    names = ["key", *once, "children", "leaves", "below"]
    kinds = ", ".join(f"{c} {'string' if c == 'key' else 'int' if c == 'first' else 'long'}" for c in names)
    tips = shards.sparkSession.createDataFrame([[v[c] for c in names] for v in nodes.values()], kinds)
    return tips.join(_digests(shards.where("kind = 2")), "key", "left").withColumn("ends", F.coalesce("ends", F.lit(NOTHING)))


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of paths: `turns` has (c, depth from 1, a, b, bytes), `convs` every path's c once."""
    send_package(turns)
    walks = _walks(turns)
    shared = walks.groupBy("depth", "x", "y").agg(F.count("*").alias("n"), F.min("c").alias("m")).where("n > 1")
    told = staged(walks.join(shared, ["depth", "x", "y"], "left").select(
        "c", "depth", "bytes", "x", "y", "after", F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("m", "c").alias("m")), "told")
    # Sets of members only shrink along a path, so the same number of members is the same set: one edge.
    edges = told.groupBy("c", "n").agg(
        F.min("depth").alias("first"), F.min("m").alias("m"), F.max("after").alias("after"),
        F.min(F.col("after") - F.col("bytes")).alias("before"), F.min_by("x", "depth").alias("x"),
        F.min_by("y", "depth").alias("y"))
    path = F.sort_array(F.collect_list(F.struct("first", "n", "m", "before", "after", "x", "y")))
    name = F.transform("edges", lambda e: F.concat(*(F.lpad(F.hex(e[v]), 16, "0") for v in "xy")))
    paths = staged(convs.join(edges.groupBy("c").agg(path.alias("edges")), "c", "left").select(
        "c", "edges", F.coalesce(F.array_join(name, ""), F.lit("")).alias("key")), "paths")
    n, least = paths.agg(F.count("*"), F.min("c")).head()
    if not n:
        return turns.sparkSession.createDataFrame(
            [], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                "saved_tokens long, ends_sha256 string")
    shards = _shards(paths, _splitters(paths, n))
    drop_staged(paths)
    skeleton = staged(_skeleton(shards, least, n), "skeleton")
    columns = ["conv_id", "n", "parent", "first", "after", "children", "leaves", "below", "ends"]
    done = shards.where("kind = 0").select(*columns).union(skeleton.where("key != ''").select(*columns))
    # A node stands in the turns of its least member.
    own = told.where("c = m").select(F.col("c").alias("conv_id"), "n", "depth", F.col("after").alias("end"), "bytes")
    ends = told.where("c = m").groupBy(F.col("c").alias("conv_id"), "n").agg(F.max("depth").alias("last"))
    last = F.col("depth") == F.col("last")
    nodes = own.join(done.join(ends, ["conv_id", "n"]), ["conv_id", "n"]).select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.coalesce("parent", F.lit(least)))
        .alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * (F.col("after") - F.col("end") + F.col("bytes"))).alias("saved_tokens"),
        F.when(last, F.col("ends")).otherwise(NOTHING).alias("ends_sha256"))
    root = skeleton.where("key = ''").select(
        "conv_id", F.lit(0).cast("long"), F.lit(None).cast("long"), "n", "children", "leaves", "below", "ends")
    return nodes.union(root)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table of conversations (conv_id, turn, role, text)."""
    turns = ordered_turns(conversations)
    convs = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("c")).distinct()
    return trie(turns.select(F.col("conv_id").alias("c"), (F.col("pos") + 1).cast("int").alias("depth"), "a", "b", "bytes"), convs)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations of the contract: the first h turns of c - c % 5, then c's own turns after its first h."""
    turns = staged(ordered_turns(conversations), "ordered")
    c = F.col("conv_id")
    sizes = turns.groupBy("conv_id", "part").agg(F.first("n").alias("n"))
    convs = staged(sizes.groupBy(c.alias("c")).agg(F.first("n").alias("n")).select(
        "c", "n", (F.col("c") - F.col("c") % 5).alias("base"),
        F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(9)).cast("int").alias("h")), "convs")
    heads = turns.where("pos < 8 and conv_id % 5 = 0").select(c.alias("base"), "pos", "a", "b", "bytes")
    given = convs.join(heads, "base").where("pos < h").select("c", (F.col("pos") + 1).alias("depth"), "a", "b", "bytes")
    base = convs.where("c % 5 = 0").select(F.col("c").alias("base"), F.col("n").alias("_n"))
    taken = convs.join(base, "base", "left").select(
        F.col("c").alias("conv_id"), "h", F.least("h", F.coalesce("_n", F.lit(0))).alias("_p"))
    # By conversation and part: no task gets more turns of a conversation than a part has.
    own = turns.where("pos >= pmod(crc32(cast(cast(conv_id as string) as binary)), 9)").join(
        sizes.select("conv_id", "part").join(taken, "conv_id"), ["conv_id", "part"]).select(
        c.alias("c"), (F.col("pos") - F.col("h") + F.col("_p") + 1).alias("depth"), "a", "b", "bytes")
    return given.union(own).withColumn("depth", F.col("depth").cast("int")), convs.select("c")


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(table(spark, sf_dir, "conversations")))


# The same with every prefix spelt out. CRC-32 is taken bit by bit: 3988292384 is its polynomial.
SQL = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id AS c, conv_id - conv_id % 5 AS base, xor(list_reduce(
        [4294967295] || flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda crc, v: CASE WHEN v >= 0 THEN xor(crc, v) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295) % 9 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c, pos, role, text FROM ids JOIN turns ON turns.conv_id = base WHERE pos < h
    UNION ALL SELECT c, pos, role, text FROM ids JOIN turns ON turns.conv_id = c WHERE pos >= h
), members AS (
    SELECT c, row_number() OVER w AS depth, octet_length(encode(text)) AS bytes,
           string_agg(md5(length(role)::VARCHAR || ':' || role || text), '') OVER w AS key
    FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY pos ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT c, 0, 0, '' FROM ids
), nodes AS (
    SELECT key, depth, min(c) AS conv_id, count(*) AS n, any_value(bytes) AS bytes FROM members GROUP BY key, depth
), ended AS (
    SELECT key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends
    FROM (SELECT c, arg_max(key, depth) AS key FROM members GROUP BY c) GROUP BY key
), kids AS (SELECT left(key, 32 * (depth - 1)::INTEGER) AS key, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
    SELECT left(nodes.key, 32 * above::INTEGER) AS key, sum((n - 1) * bytes)::BIGINT AS saved, count(*) FILTER (kids.key IS NULL) AS leaves
    FROM nodes LEFT JOIN kids USING (key), unnest(range(0, depth + 1)) AS u(above) GROUP BY 1
)
SELECT nodes.conv_id, nodes.depth, over.conv_id AS parent_conv_id, nodes.n AS n_convs, coalesce(children, 0) AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM nodes JOIN below USING (key) LEFT JOIN kids USING (key) LEFT JOIN ended USING (key)
LEFT JOIN nodes AS over ON nodes.depth > 0 AND over.key = left(nodes.key, 32 * (nodes.depth - 1)::INTEGER)
"""
