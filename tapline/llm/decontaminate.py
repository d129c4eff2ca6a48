"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Words are runs of letters and digits, in lower case. One pass over the corpus counts in how many documents each run of
`SEED_WORDS` words of a test item stands alone, that is without another run of the item in the same stretch. Such a
document does not hold the item, and a copy, exact or edited, counts against none of its runs however often it leaked.
A run that stands alone in more than `FREQUENT_SHARE` of the documents (and in more than `FREQUENT_LEAST`) is frequent; all
others are rare, and so are the `LEAST_SEEDS` least frequent runs of each item. A second pass finds runs in every whole
text; where two of an item's runs (or its only one) fall within one stretch and one of them is rare, the stretch is aligned
with the item by Smith-Waterman over words (match 2, other word -1, gap -1). The share of the item's best score is the
score of the pair, so edited and paraphrased copies count.

Documents are not shuffled in either pass. Test items travel to the tasks in blocks of at most `BLOCK_BYTES` of text, one
pair of passes for each block, so what is broadcast is bounded for benchmarks of any size. Only counts per run of a block
come back to the driver.

Nulls and empty texts match nothing, items without a word neither; items of fewer words than a seed are sought as a whole.
Items with the same words all match. Repeated documents are marked alike; an input column with the name of the result is
replaced; an empty corpus or benchmark gives no match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapline.llm.common import blocks, send_package, strings_of, table, with_columns

SEED_WORDS, LEAST_SEEDS, THRESHOLD = 3, 8, 0.5
FREQUENT_SHARE, FREQUENT_LEAST = 0.001, 100
BLOCK_BYTES = 8 << 20
MATCHES = "array<struct<item_id: bigint, score: double, start: int, stop: int>>"
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Items:
    """Test items as word numbers, and where each run of words stands in them."""

    ids: list[list[int]]
    words: list[np.ndarray]
    vocabulary: dict[str, int]
    # By length of the run: keys in order, and of each key its places as ranges of (item, position).
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    ranges: dict[int, np.ndarray] = field(default_factory=dict)
    places: dict[int, np.ndarray] = field(default_factory=dict)
    # Of each place whether its run is rare.
    rare: dict[int, np.ndarray] = field(default_factory=dict)
    salt: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        same: dict[tuple[str, ...], list[int]] = {}
        for item, text in sorted(rows):
            if found := tuple(words_of(text)):
                same.setdefault(found, []).append(item)
        vocabulary = {w: i for i, w in enumerate(sorted({w for found in same for w in found}))}
        self = cls(list(same.values()), [np.array([vocabulary[w] for w in found]) for found in same], vocabulary)
        self.salt = np.random.default_rng(1).integers(0, 1 << 64, (SEED_WORDS, len(vocabulary) + 1), np.uint64)
        for size in sorted({min(SEED_WORDS, len(w)) for w in self.words}):
            key, place = [], []
            for i, w in enumerate(self.words):
                if min(SEED_WORDS, len(w)) == size:
                    key.append(self.runs(w, size))
                    place.append(np.stack([np.full(len(key[-1]), i), np.arange(len(key[-1]))], axis=1))
            self._index(size, np.concatenate(key), np.concatenate(place))
        return self

    def _index(self, size: int, key: np.ndarray, place: np.ndarray) -> None:
        order = np.argsort(key, kind="stable")
        self.keys[size], starts = np.unique(key[order], return_index=True)
        self.ranges[size], self.places[size] = np.append(starts, len(key)), place[order]
        self.rare[size] = np.ones(len(key), bool)

    def lengths(self) -> np.ndarray:
        return np.array([len(w) for w in self.words], np.int64)

    def runs(self, words: np.ndarray, size: int) -> np.ndarray:
        """A key for each run of `size` words."""
        n = max(0, len(words) - size + 1)
        return sum((self.salt[i][words[i:n + i]] for i in range(size)), np.zeros(n, np.uint64))

    def hits(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in a sequence of word numbers (-1: not in any item) where a known run starts, and the run."""
        n = len(words) - size + 1
        if n <= 0 or not len(self.keys[size]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = np.ones(n, bool)
        for i in range(size):
            inside &= words[i:n + i] >= 0
        at = np.flatnonzero(inside)
        key = sum((self.salt[i][words[at + i]] for i in range(size)), np.zeros(len(at), np.uint64))
        slot = np.minimum(np.searchsorted(self.keys[size], key), len(self.keys[size]) - 1)
        true = self.keys[size][slot] == key
        return at[true], slot[true]

    def only_rare(self, alone: dict[tuple[int, int], int], docs: int) -> Items:
        """The same items with the runs marked that stand alone in few documents (and `LEAST_SEEDS` at least)."""
        limit = max(FREQUENT_LEAST, FREQUENT_SHARE * docs)
        rare = {}
        for size, places in self.places.items():
            count = np.array([alone.get((size, r), 0) for r in range(len(places))], np.int64)
            order = np.lexsort((places[:, 1], count, places[:, 0]))
            item = places[order, 0]
            rare[size] = count <= limit
            rare[size][order[np.arange(len(order)) - np.searchsorted(item, item) < LEAST_SEEDS]] = True
        return replace(self, rare=rare)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, -1 between them, and where each text starts."""
        found = [words_of(text) for text in texts]
        starts = np.cumsum([0, *(len(w) + 1 for w in found)])
        out = np.full(starts[-1], -1, np.int64)
        for start, w in zip(starts, found, strict=False):
            out[start:start + len(w)] = np.fromiter(map(self.vocabulary.get, w, repeat(-1)), np.int64, len(w))
        return out, starts


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score, and the end of the best stretch of the passage."""
    place = np.arange(len(passage) + 1)
    row, best, stop = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item:
        step = np.zeros_like(row)
        step[1:] = row[:-1] + np.where(passage == word, 2, -1)
        np.maximum(step, row - 1, out=step)
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + place) - place
        at = int(row.argmax())
        if row[at] > best:
            best, stop = int(row[at]), at
    return best, stop


@dataclass
class Stretches:
    """Runs of items in texts, in order of text, item and place; each stretch begins at one of `cuts`."""

    text: np.ndarray
    item: np.ndarray
    # Where the item would begin.
    begin: np.ndarray
    # Words of the run, and the row of `Items.places`.
    size: np.ndarray
    row: np.ndarray
    rare: np.ndarray
    cuts: np.ndarray
    # Of each stretch whether it holds two runs of its item, or the only one.
    enough: np.ndarray


def stretches(items: Items, words: np.ndarray, starts: np.ndarray) -> Stretches | None:
    found = []
    for size in items.keys:
        at, run = items.hits(words, size)
        many = np.diff(items.ranges[size])[run]
        first = np.repeat(items.ranges[size][run], many)
        row = first + np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
        place = items.places[size][row]
        found.append((np.repeat(at, many), *place.T, np.full(len(row), size), row, items.rare[size][row]))
    if not found:
        return None
    spot, item, place, size, row, rare = (np.concatenate(x) for x in zip(*found, strict=True))
    if not len(spot):
        return None
    text = np.searchsorted(starts, spot, side="right") - 1
    order = np.lexsort((spot - place, item, text))
    text, item, place, begin = text[order], item[order], place[order], (spot - place)[order]
    length = items.lengths()[item]
    far = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1])
                    | (begin[1:] - begin[:-1] > length[1:] // 2 + 4))
    cuts = np.flatnonzero(far)
    enough = (np.minimum.reduceat(place, cuts) < np.maximum.reduceat(place, cuts)) | (length[cuts] <= SEED_WORDS)
    return Stretches(text, item, begin, size[order], row[order], rare[order], cuts, enough)


def matches(items: Items, words: np.ndarray, starts: np.ndarray, threshold: float) -> list[list[tuple]]:
    """Of each text: (item, score, start, stop) of the items that it holds."""
    out: list[list[tuple]] = [[] for _ in range(len(starts) - 1)]
    found = stretches(items, words, starts)
    if found is None:
        return out
    length, begin = items.lengths(), found.begin
    wanted = found.enough & np.logical_or.reduceat(found.rare, found.cuts)
    ends = np.append(found.cuts[1:], len(found.text))
    best: dict[tuple[int, int], tuple] = {}
    for a, b in zip(found.cuts[wanted], ends[wanted], strict=True):
        t, i = int(found.text[a]), int(found.item[a])
        pad = length[i] // 4 + 4
        low = max(int(starts[t]), int(begin[a]) - pad)
        high = min(int(starts[t + 1]) - 1, int(begin[b - 1]) + length[i] + pad)
        passage = words[low:high]
        score, stop = align(items.words[i], passage)
        share = score / (2 * length[i])
        if share >= threshold and share > best.get((t, i), (0,))[0]:
            _, back = align(items.words[i][::-1], passage[:stop][::-1])
            best[t, i] = (share, low - int(starts[t]) + stop - back, low - int(starts[t]) + stop)
    for (t, i), (share, start, stop) in sorted(best.items()):
        out[t] += [(item_id, share, start, stop) for item_id in items.ids[i]]
    return out


def _count_alone(docs: DataFrame, items: Items) -> tuple[dict[tuple[int, int], int], int]:
    """In how many documents each run of the items stands alone, by size and row of its place; and all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {size: np.zeros(len(places), np.int64) for size, places in items.places.items()}
        texts = 0
        for batch in batches:
            texts += len(batch)
            for a, b in blocks(batch.column(0)):
                found = stretches(items, *items.numbers(strings_of(batch.column(0)[a:b])))
                if found is None:
                    continue
                lone = ~np.repeat(found.enough, np.diff(np.append(found.cuts, len(found.text))))
                for size, counts in total.items():
                    here = lone & (found.size == size)
                    once = np.unique(found.text[here] * len(counts) + found.row[here]) % len(counts)
                    counts += np.bincount(once, minlength=len(counts))
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([texts])], ["size", "run", "n"])
        for size, counts in total.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), size)), pa.array(seen), pa.array(counts[seen])], ["size", "run", "n"])

    rows = docs.mapInArrow(run, "size bigint, run bigint, n bigint").groupBy("size", "run").agg(F.sum("n").alias("n"))
    alone = {(r.size, r.run): r.n for r in rows.collect()}
    return alone, alone.pop((0, 0), 0)


def mark(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
         to: str = "matches") -> DataFrame:
    """Add the test items (item_id and text of `benchmark`) that each whole text holds, with score and word span."""
    send_package(docs)
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "item_id is not null and text is not null")
    size = tests.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    count = -(-size // BLOCK_BYTES)
    texts = docs.select(F.col(text_col).alias("t")).where("t is not null")
    found = []
    for block in range(count):
        rows = tests.where(F.pmod(F.xxhash64("text"), F.lit(count)) == block).collect()
        items = Items.of([(r.item_id, r.text) for r in rows])
        found.append(_matcher(items.only_rare(*_count_alone(texts, items)), threshold)(F.col(text_col)))
    return with_columns(docs, {to: F.concat(*found) if found else F.array().cast(MATCHES)})


def _matcher(items: Items, threshold: float):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int32()),
                               ("stop", pa.int32())]))

    @F.arrow_udf(MATCHES)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            done: list[list[dict]] = []
            for a, b in blocks(column):
                for text in matches(items, *items.numbers(strings_of(column[a:b])), threshold):
                    done.append([{"item_id": i, "score": s, "start": x, "stop": y} for i, s, x, y in text])
            yield pa.array(done, kind)

    return run


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that hold no test item."""
    marked = mark(docs, benchmark, threshold, to="_tl_matches")
    return marked.where(F.size("_tl_matches") == 0).select(*docs.columns)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each pair of a document and a test item that it holds; places count words from 0, stop exclusive."""
    marked = mark(docs.select("doc_id", "text"), benchmark)
    return marked.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
