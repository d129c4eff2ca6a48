"""Best-two-fit packing of token pieces into sequences of a fixed size.

A bin is filled greedily, the longest piece that fits first. When nothing fits any more, its smallest piece gives way to two
unpacked pieces if two of them fill the room it leaves more tightly. Which bins result depends only on how many pieces there
are of each length, and lengths end at the capacity. So Spark counts the lengths, the driver packs these counts (a table of
at most `capacity` numbers, however many pieces there are; equal bins are made at once), and Spark deals the pieces out: a
piece of some length takes the place that its rank among the pieces of that length has in the plan. Ranks are counted in lanes
of each length, so a length that a third of all pieces have is shared by many tasks, and only narrow rows are shuffled.

Null and empty texts have no ids of their own, only the one that ends a document. Texts of any length stream by. Repeated rows
are documents of their own, equal lengths are interchangeable, an empty table packs into nothing, and other columns of the
input are left out. A length below one or above the capacity is an error.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapline.llm.byte_bpe import byte_characters, narrow_pattern
from tapline.llm.common import blocks, send_package, staged, strings_of, table

CAPACITY = 2048
# Parts of texts kept with their ids in each Python worker, the longest of them, and characters looked at together.
REMEMBERED, LONGEST, AT_ONCE = 300_000, 64, 1 << 20
# Bits of a place in the plan that hold the rank.
_RANK_BITS = 44


class Vocabulary:
    """Ids of whole texts under a vocabulary that drops white space.

    Where the vocabulary puts texts in lower case and parts them by one pattern, texts of Latin-1 characters, to which no
    other rule of it applies, are parted here, and each new part is coded by the library's model once. Other stretches
    between blanks (all, for any other vocabulary) are coded by the library as a whole. What came back once it was known is
    kept when room is needed, the rest goes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = str.maketrans(dict(enumerate(byte_characters())))
        self.find = _part_pattern(json.loads(self.tokenizer.to_str()))
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.known: dict[str, bytes] = {}
        self.met: set[str] = set()

    def _plain(self, text: str) -> bool:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return not any(mark in text for mark in self.marks)

    def _split(self, text: str, odd: set[str]) -> list[str]:
        """What a text is coded from, in order; stretches for the library are added to `odd` too."""
        if self.find and self._plain(text):
            return self.find.findall(text.lower())
        out = []
        for stretch in text.replace("\n", " ").replace("\t", " ").split(" "):
            if self.find and self._plain(stretch):
                out += self.find.findall(stretch.lower())
            else:
                out.append(stretch)
                odd.add(stretch)
        return out

    def _learn(self, words: set[str], odd: set[str]) -> None:
        new = words.difference(self.known)
        self.met.update(words.difference(new))
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {word: self.known[word] for word in self.met}
            self.met = set()
            if len(self.known) + len(new) > REMEMBERED:
                self.known, new = {}, words
        whole = [word for word in new if word in odd]
        for word, coded in zip(whole, self.tokenizer.encode_batch(whole, add_special_tokens=False), strict=True):
            self.known[word] = np.array(coded.ids, "<u4").tobytes()
        model, packed = self.tokenizer.model.tokenize, self.packed
        for word in new.difference(odd):
            mapped = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)
            self.known[word] = b"".join([packed[t.id] for t in model(mapped)])

    def _join(self, texts: list[str]) -> list[bytes]:
        odd: set[str] = set()
        split = [self._split(text, odd) for text in texts]
        words = set().union(*split)
        self._learn(words, odd)
        out = [b"".join(map(self.known.__getitem__, parts)) for parts in split]
        for word in words:
            if len(word) > LONGEST:
                del self.known[word]
                self.met.discard(word)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        if all(len(text) <= AT_ONCE for text in texts):
            return self._join(texts)
        return [b"".join(self._join([part])[0] for part in _parts(text)) for text in texts]


def _part_pattern(config: dict) -> re.Pattern | None:
    """The pattern that parts texts, for Latin-1 characters in lower case; None if the vocabulary has other rules."""
    rules = [n["type"] for n in (config["normalizer"] or {}).get("normalizers", [])]
    parts = (config["pre_tokenizer"] or {}).get("pretokenizers", [])
    if rules != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
        return None
    cut, coding = parts
    plain = cut["invert"] and cut["behavior"] == "Removed" and not coding["add_prefix_space"] and not coding["use_regex"]
    blanks = config["normalizer"]["normalizers"][1]
    if not plain or (blanks["pattern"], blanks["content"]) != ({"Regex": r"\s+"}, " "):
        return None
    return narrow_pattern(cut["pattern"]["Regex"])


def _parts(text: str) -> Iterator[str]:
    """A text in parts that end before blanks."""
    start = 0
    while start < len(text):
        stop = text.find(" ", start + AT_ONCE)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop]
        start = stop


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    # The tasks of an executor are what runs side by side here.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabulary(path)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id_col, piece, start, length, ids) of the pieces of each document's ids, which end with `end_id`."""
    send_package(docs)
    kind = docs.schema[id_col].dataType.simpleString()
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for first, stop in blocks(texts):
                coded = [ids + end for ids in words.encode(strings_of(texts[first:stop]))]
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                count = -(-sizes // capacity)
                row = np.repeat(np.arange(len(coded)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                ids = [coded[r][4 * s:4 * (s + capacity)] for r, s in zip(row.tolist(), start.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [names[first:stop].take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start),
                     pa.array(np.minimum(sizes[row] - start, capacity)), pa.array(ids, pa.binary())],
                    [id_col, "piece", "start", "length", "ids"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids binary")


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins as (pieces of each length, number of such bins), in the order in which they are filled."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    at = np.arange(capacity + 1)
    fits = np.maximum.accumulate(np.where(left > 0, at, 0))
    out = []
    while fits[-1]:
        taken, gap, longest = {}, capacity, int(fits[-1])
        while longest:
            taken[longest] = min(int(left[longest]), gap // longest)
            gap -= taken[longest] * longest
            longest = int(fits[min(gap, longest - 1)])
        use, need = dict(taken), dict(taken)
        smallest = min(taken)
        pair = _tighter(left, taken, gap + smallest, smallest) if gap and sum(taken.values()) > 1 else ()
        if pair:
            use[smallest] -= 1
            for length in pair:
                use[length] = use.get(length, 0) + 1
                need[length] = need.get(length, 0) + 1
        # The same bin comes again as long as what the choice rests on is there.
        times = min((int(left[n]) - need[n]) // u + 1 for n, u in use.items() if u)
        out.append(({n: u for n, u in use.items() if u}, times))
        for length, u in use.items():
            left[length] -= u * times
        if not all(left[n] for n in use):
            fits = np.maximum.accumulate(np.where(left > 0, at, 0))
    return out


def _tighter(left: np.ndarray, taken: dict[int, int], room: int, least: int) -> tuple[int, ...]:
    """The two unpacked lengths that fill `room` best, if they fill more of it than `least`."""
    spare = left[:room].copy()
    for length, n in taken.items():
        if length < room:
            spare[length] -= n
    at = np.arange(room)
    fits = np.maximum.accumulate(np.where(spare > 0, at, 0))
    one = np.flatnonzero(spare > 0)
    if not len(one):
        return ()
    other = fits[room - one]
    alone = (other == one) & (spare[one] < 2)
    other[alone] = fits[one[alone] - 1]
    both = np.where(other > 0, one + other, 0)
    best = int(both.argmax())
    return (int(one[best]), int(other[best])) if both[best] > least else ()


def _places(bins: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Runs of places: from rank `first` of a length on, `uses` pieces lie side by side in each bin from `bin` on, at `offset`."""
    used: dict[int, int] = {}
    rows, number = [], 0
    for held, times in bins:
        offset = 0
        for length in sorted(held, reverse=True):
            rows.append((length, used.get(length, 0), held[length], number, offset))
            used[length] = used.get(length, 0) + held[length] * times
            offset += held[length] * length
        number += times
    table_ = np.array(rows, np.int64).reshape(-1, 5)
    table_ = table_[np.lexsort((table_[:, 1], table_[:, 0]))]
    return {"at": (table_[:, 0] << _RANK_BITS) | table_[:, 1], "first": table_[:, 1], "uses": table_[:, 2],
            "bin": table_[:, 3], "offset": table_[:, 4]}


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """Add the sequence of each piece and its offset there; the pieces of a sequence lie side by side from offset 0."""
    send_package(pieces)
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    # Row numbers are written down, so that all later jobs see the same ones.
    rows = staged(pieces.select(*(F.col(f"`{c}`") for c in kept), F.monotonically_increasing_id().alias("_row")), "pieces")
    lanes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("_length", F.col(f"`{length_col}`").cast("long")).withColumn(
        "_lane", F.pmod(F.xxhash64("_row"), F.lit(lanes)).cast("int"))
    valid = F.coalesce(F.col("_length").between(1, capacity), F.lit(False))
    lengths = staged(rows.groupBy(F.when(valid, F.col("_length")).alias("_length"), "_lane").agg(
        F.count("*").alias("_n")), "lengths")
    counts = {r[0]: r[1] for r in lengths.groupBy("_length").agg(F.sum("_n")).collect()}
    if None in counts:
        raise ValueError(f"{counts[None]} pieces have no length from 1 to {capacity}")
    plan = _places(best_two_fit(counts, capacity))
    before = Window.partitionBy("_length").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    firsts = lengths.select("_length", "_lane", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("_length", "_lane").orderBy("_row")) - 1
    ranked = rows.withColumn("_rank", rank).join(firsts.hint("merge"), ["_length", "_lane"]).select(
        *(F.col(f"`{c}`") for c in kept), "_length", (F.col("_rank") + F.col("_first")).alias("_rank"))
    shared = spark.sparkContext.broadcast(plan)

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        runs = shared.value
        length, rank = (x.to_numpy(zero_copy_only=False) for x in (length, rank))
        i = np.searchsorted(runs["at"], (length << _RANK_BITS) | rank, side="right") - 1
        bin_, nth = np.divmod(rank - runs["first"][i], runs["uses"][i])
        return pa.StructArray.from_arrays(
            [pa.array(runs["bin"][i] + bin_), pa.array(runs["offset"][i] + nth * length)], ["sequence_id", "offset"])

    placed = ranked.withColumn("_place", place("_length", "_rank"))
    return placed.select(*(F.col(f"`{c}`") for c in kept), "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts): the ids of each sequence, and where its pieces start. `packed` has the ids of the pieces."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(pieces.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.col("p.offset").alias("starts"))


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
