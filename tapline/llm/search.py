"""Ranked lexical search for many queries at once, by evaluating what they share only once.

Every item is a set of terms, and a document's score for it is a sum over these terms. Terms that the same items hold are one
atom. Atoms that several items hold together are mined greedily, the pair shared by most items first, into nodes of a sharing
graph: a node is the sum of two others. For a block of documents the accumulators of atoms and nodes are filled once, each
node from two arrays that are there already, and an item adds up the few nodes that make it. All sums are of integers.

Items are taken in blocks (of `PAIRS` pairs of terms, one item at least), which bounds what is sent to the tasks; each block is
searched in all documents. One job counts the terms of the block in every whole text and writes the counts down, together with
what the weights need; a second one scores them. A task keeps the best rows of each item that it has seen and nothing else,
and the best of all tasks are ranked in two steps, so no task sees more than the best rows of a bounded number of others.

Null and empty texts hold no term, and rank nowhere. Texts of any length are counted in stretches. Repeated rows of a document
are documents of their own; rows of an item with the same id are one item with the terms of all of them, and an item without
terms or id has no rows. Equal scores are ordered by document id (null last). Empty tables give no rows; only id and text of
either table are read. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapline.llm.common import blocks, bytes_of, drop_staged, send_package, staged, table, word_hashes

# Pairs of terms of the items of a block, bytes of accumulators in a task, rows a task gathers before it drops the worse ones.
PAIRS, ACCUMULATORS, GATHERED = 4_000_000, 8 << 20, 200_000
# Bytes of a text whose terms are counted together; tasks whose best rows are merged by one.
STRETCH, MERGED = 1 << 20, 64
# Characters of terms: ASCII letters and digits, and all beyond ASCII.
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}
# What each byte counts as: itself in a term, A-Z in lower case, else a blank.
_BYTES = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)
_BYTES[65:91] += 32
_LAST = np.iinfo(np.int64).max


def terms_of(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_LOWER))


def hashes_of(terms: list[str]) -> np.ndarray:
    return word_hashes(pa.array(terms, pa.string()))[0]


def stretches(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the terms of a block of texts and the row of each; a long block comes in stretches cut between terms."""
    view, starts = bytes_of(column)
    view, begin = _BYTES[view], 0
    while begin < len(view):
        stop = min(len(view), begin + STRETCH)
        while stop < len(view) and view[stop] != 32:
            blank = np.flatnonzero(view[stop:stop + STRETCH] == 32)
            stop = stop + int(blank[0]) if len(blank) else min(len(view), stop + STRETCH)
        first, last = np.searchsorted(starts, (begin, stop - 1), side="right") - 1
        offsets = np.clip(starts[first:last + 2], begin, stop) - begin
        texts = pa.LargeStringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(view[begin:stop])))
        hashes, sizes = word_hashes(texts)
        yield hashes, np.repeat(np.arange(first, last + 1), sizes)
        begin = stop


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[dict[int, list[str]]]:
    """The items with their terms, as many at a time as the bound on pairs lets through."""
    rows = items.where(F.col(id_col).isNotNull()).select(id_col, text_col).orderBy(id_col).toLocalIterator()
    block, pairs = {}, 0
    for item, group in itertools.groupby(rows, key=lambda r: r[0]):
        terms = sorted({t for r in group for t in terms_of(r[1])})
        if block and pairs + len(terms) ** 2 > PAIRS:
            yield block
            block, pairs = {}, 0
        if terms:
            block[item] = terms
            pairs += len(terms) ** 2
    if block:
        yield block


class Sharing:
    """The sharing graph of a block of items: terms to atoms, nodes as pairs of earlier ones, items as lists of nodes."""

    def __init__(self, items: dict[int, list[str]]):
        self.items = list(items)
        holders = defaultdict(list)
        for i, terms in enumerate(items.values()):
            for t in terms:
                holders[t].append(i)
        self.terms = sorted(holders)
        by_items = defaultdict(list)
        for n, t in enumerate(self.terms):
            by_items[tuple(holders[t])].append(n)
        self.atom = np.zeros(len(self.terms), np.int64)
        parts: list[set[int]] = [set() for _ in self.items]
        for a, (held_by, terms) in enumerate(by_items.items()):
            self.atom[terms] = a
            for i in held_by:
                parts[i].add(a)
        self.atoms = len(by_items)
        self.nodes = self._mine(parts)
        self.parts = [np.array(sorted(p), np.int64) for p in parts]

    def _mine(self, parts: list[set[int]]) -> list[tuple[int, int]]:
        """Replace pairs that several items hold by nodes, the most frequent pair first."""
        shared = Counter(a for p in parts for a in p)
        together: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, p in enumerate(parts):
            for pair in itertools.combinations(sorted(a for a in p if shared[a] > 1), 2):
                together[pair].add(i)
        heap = [(-len(held), pair) for pair, held in together.items() if len(held) > 1]
        heapq.heapify(heap)
        nodes = []
        while heap:
            n, pair = heapq.heappop(heap)
            held = together[pair]
            if len(held) < 2:
                continue
            if len(held) != -n:
                heapq.heappush(heap, (-len(held), pair))
                continue
            node = self.atoms + len(nodes)
            nodes.append(pair)
            for i in list(held):
                parts[i] -= set(pair)
                for other in parts[i]:
                    for x in pair:
                        together.get((min(x, other), max(x, other)), set()).discard(i)
                    together[other, node].add(i)
                parts[i].add(node)
            together[pair] = set()
            for pair_, held_ in [((o, node), together[o, node]) for o in {o for i in held for o in parts[i]} if o != node]:
                if len(held_) > 1:
                    heapq.heappush(heap, (-len(held_), pair_))
        return nodes

    def additions(self) -> int:
        """Array additions for a block of documents."""
        return len(self.nodes) + sum(max(0, len(p) - 1) for p in self.parts)


def count_terms(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, term, tf) of every text that holds a term at all: n terms in it, and how often which of the given ones."""
    send_package(docs)
    hashes = hashes_of(terms)
    order = np.argsort(hashes)
    shared = docs.sparkSession.sparkContext.broadcast((hashes[order], order.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shared.value
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for start, stop in blocks(texts, STRETCH):
                size = np.zeros(stop - start, np.int64)
                keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
                for found, row in stretches(texts[start:stop]):
                    size += np.bincount(row, minlength=stop - start)
                    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    met = known[at] == found
                    some, tf = np.unique(row[met] * len(known) + number[at[met]], return_counts=True)
                    keys, back = np.unique(np.append(keys, some), return_inverse=True)
                    counts = np.bincount(back, np.append(counts, tf), len(keys)).astype(np.int64)
                kept = np.flatnonzero(size)
                row, term = np.divmod(keys, len(known))
                ends = pa.array(np.append(np.searchsorted(row, kept), len(row)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [names[start:stop].take(pa.array(kept)), pa.array(size[kept]),
                     pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(counts))], ["doc_id", "n", "term", "tf"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(
        run, "doc_id long, n long, term array<int>, tf array<long>")


def weights(counted: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """N, L, and the integer weight of each term."""
    many, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).head()
    df = np.zeros(terms, np.int64)
    for term, n in counted.select(F.explode("term").alias("t")).groupBy("t").count().collect():
        df[term] = n
    return many, length, np.array([math.floor(1000 * math.log((2 * many + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Best:
    """The best rows of each item so far: highest score first, then least id."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.waiting, self.size = [], 0

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.least[:, None])
        self.waiting.append((item, scores[item, at], docs[at]))
        self.size += len(item)
        if self.size > GATHERED:
            self.settle()

    def settle(self) -> None:
        self.item, self.score, self.doc = (
            np.concatenate(x) for x in zip((self.item, self.score, self.doc), *self.waiting, strict=True))
        order = np.lexsort((self.doc, -self.score, self.item))
        item = self.item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[rank < self.top]
        self.item, self.score, self.doc = self.item[order], self.score[order], self.doc[order]
        full = rank == self.top - 1
        # A row must at least equal the last one of a full list.
        self.least[item[full]] = self.score[np.searchsorted(self.item, item[full], side="right") - 1]
        self.waiting, self.size = [], 0


def score(counted: DataFrame, graph: Sharing, top: int) -> DataFrame:
    """(item, doc_id, score): the best rows of each item in each task."""
    many, length, weight = weights(counted, len(graph.terms))
    shared = counted.sparkSession.sparkContext.broadcast((graph.atom, graph.nodes, graph.parts, graph.atoms, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        atom, nodes, parts, atoms, weight = shared.value
        width = max(16, ACCUMULATORS // (8 * (atoms + len(nodes) + len(parts))))
        best = Best(len(parts), top)
        for batch in batches:
            for start in range(0, len(batch), width):
                part = batch.slice(start, width)
                ids, n, terms, tfs = part.columns
                docs, n = ids.fill_null(_LAST).to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False)
                term, tf = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (terms, tfs))
                row = np.repeat(np.arange(len(docs)), np.diff(terms.offsets.to_numpy()))
                m = 50 + (50 * n * many) // length
                gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
                # Sums stay far below 2^53, so doubles hold them exactly.
                held = np.empty((atoms + len(nodes), len(docs)), np.int64)
                held[:atoms] = np.bincount(atom[term] * len(docs) + row, gain, atoms * len(docs)).reshape(atoms, -1)
                for i, (x, y) in enumerate(nodes, atoms):
                    np.add(held[x], held[y], out=held[i])
                best.add(np.stack([held[p].sum(axis=0) for p in parts]), docs)
        if best.waiting:
            best.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int32()), pa.array(best.doc, mask=best.doc == _LAST), pa.array(best.score)],
            ["item", "doc_id", "score"])

    return counted.mapInArrow(run, "item int, doc_id long, score long")


def _highest(rows: DataFrame, top: int, *groups: str) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = 50, item_col: str = "item_id", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of the highest score above 0 for each item."""
    spark = docs.sparkSession
    done = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items, item_col, text_col):
        graph = Sharing(block)
        counted = staged(count_terms(docs, graph.terms, id_col, text_col), "terms")
        found = score(counted, graph, top).withColumn("_some", F.spark_partition_id() % MERGED)
        ranked = _highest(_highest(found, top, "item", "_some").drop("rank"), top, "item")
        named = spark.createDataFrame(list(enumerate(graph.items)), "item int, item_id long")
        rows = staged(ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"), "found")
        drop_staged(counted)
        done = done.unionByName(rows)
    return done


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The same by plain joins and sums.
SQL = r"""
WITH words AS (
    SELECT doc, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents)
), sizes AS (SELECT doc, count(*) AS n FROM words GROUP BY doc),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
counts AS (SELECT doc, doc_id, term, count(*) AS tf FROM words GROUP BY doc, doc_id, term),
weighted AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, whole GROUP BY term
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT
        AS score
    FROM wanted JOIN counts USING (term) JOIN weighted USING (term) JOIN sizes USING (doc), whole
    GROUP BY item_id, doc, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
