"""Near duplicates by SimHash fingerprints and meet-in-the-middle ball hashing.

Every distinct fingerprint stands for all variants within half the radius (1 + 64 + 2016 of them for a radius of 4). Two
fingerprints within the radius share a variant, and two that share one are within the radius, so fingerprints are linked
exactly where their variants collide.

Variants are shuffled in blocks: a bucket holds the variants that begin with the same bits, and a fingerprint goes once to
each bucket that any of its variants fall into. The task that owns a bucket spells the variants out, one sub-range at a
time, so memory follows the number of fingerprints of the bucket and not that of variants, sorts them, and links all
fingerprints of a variant to the least of them after an exact check of their distance. Per bucket only a spanning forest
leaves, at most one link for each fingerprint. More fingerprints mean more, not larger, buckets.

A text without words has fingerprint zero and is linked like any other; so is a null text. Repeated rows share a class. A
component is named by its least id, ids that are null are not least; a component that has only such ids has no name. An
input column with the name of a result column is replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapline.llm.common import blocks, majority_bits, send_package, staged, strings_of, table, with_columns
from tapline.llm.components import components
from tapline.llm.shingle_sets import band_keys, set_hashes, similar_links

BITS, SEED = 64, 42
# Fingerprints of a bucket that are aimed at, and variants that a task spells out at once.
BUCKET, AT_ONCE = 4096, 1 << 20


def shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the runs of `words` words of all texts, and how many each text has."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        # bytes.lower() and bytes.split() know ASCII letters and white space only, which is what is meant.
        found = text.encode().lower().split()
        if not found:
            continue
        joined = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        run = min(words, len(found))
        spans = zip(starts[:len(found) - run + 1].tolist(), ends[run - 1:].tolist(), strict=True)
        hashes += [digest(joined[a:b], SEED) for a, b in spans]
        sizes[i] = len(found) - run + 1
    return np.array(hashes, np.uint64), sizes


def shingle_bits(texts: list[str], words: int) -> np.ndarray:
    """The fingerprint of each text over its runs of `words` words."""
    return majority_bits(*shingles(texts, words))


def fingerprint(docs: DataFrame, words: int = 4, text_col: str = "text", to: str = "fingerprint") -> DataFrame:
    """Add the 64-bit fingerprint of each whole text as a signed long."""
    send_package(docs)

    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            done = [shingle_bits(strings_of(column[a:b]), words) for a, b in blocks(column)]
            yield pa.array(np.concatenate([np.zeros(0, np.uint64), *done]).view(np.int64))

    return with_columns(docs, {to: run(F.col(text_col))})


def ball(radius: int, bits: range) -> np.ndarray:
    """All masks of up to `radius` of the given bits."""
    ones = [np.uint64(1) << np.uint64(i) for i in bits]
    return np.array([sum(c, np.uint64(0)) for n in range(radius + 1) for c in combinations(ones, n)], np.uint64)


def bucket_bits(count: int) -> int:
    """Leading bits that name a bucket, for so many fingerprints."""
    return min(24, max(2, int(np.ceil(np.log2(max(1, count) / BUCKET))))) if count else 2


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def bucket_links(own: np.ndarray, prefix: int, lead: int, radius: int) -> np.ndarray:
    """Links (a > b) of a forest that spans what collides in the bucket `prefix`.

    `own` are the distinct fingerprints with a variant there, `lead` the number of bits of the prefix.
    """
    half = radius // 2
    rest = BITS - lead
    top = own >> np.uint64(rest)
    spent = _popcount(top ^ np.uint64(prefix)).astype(np.int64)
    root = np.arange(len(own))
    low = np.uint64((1 << rest) - 1)
    # The next bits split the bucket so that the variants of one part fit in memory.
    variants = sum(len(ball(half - n, range(rest))) * int((spent == n).sum()) for n in range(half + 1))
    more = min(rest - 1, max(0, int(np.ceil(np.log2(max(1, variants) / AT_ONCE)))))
    left = rest - more
    masks = {n: ball(n, range(left)) for n in range(half + 1)}
    links = []
    for part in range(1 << more):
        values, owners = [], []
        used = spent + _popcount(((own & low) >> np.uint64(left)) ^ np.uint64(part)).astype(np.int64)
        for n in range(half + 1):
            here = np.flatnonzero(used == half - n)
            if len(here):
                tail = own[here] & np.uint64((1 << left) - 1)
                values.append((tail[:, None] ^ masks[n][None, :]).ravel())
                owners.append(np.repeat(here, len(masks[n])))
        if not values:
            continue
        value, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(value, kind="stable")
        value, owner = value[order], owner[order]
        same = np.append(False, value[1:] == value[:-1])
        if not same.any():
            continue
        start = np.maximum.accumulate(np.where(same, 0, np.arange(len(value))))
        a, b = owner[same], owner[start[same]]
        pairs = np.unique(np.minimum(a, b) * len(own) + np.maximum(a, b))
        a, b = pairs // len(own), pairs % len(own)
        true = (a != b) & (_popcount(own[a] ^ own[b]) <= radius)
        links.append(np.stack([a[true], b[true]], axis=1))
    for a, b in np.concatenate(links).tolist() if links else ():
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        while root[b] != b:
            root[b] = root[root[b]]
            b = root[b]
        root[max(a, b)] = min(a, b)
    for i in range(len(root)):
        root[i] = root[root[i]]
    moved = np.flatnonzero(root != np.arange(len(root)))
    return np.stack([own[moved], own[root[moved]]], axis=1)


def links_within(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints (one long column) whose components are those of all true links."""
    send_package(distinct)
    lead = bucket_bits(distinct.count())
    value = F.col(distinct.columns[0])
    reach = [int(m) for m in ball(radius // 2, range(lead))]
    sent = distinct.select(
        value.alias("fp"),
        F.explode(F.array(*(F.lit(m) for m in reach))).alias("mask"),
    ).select("fp", F.shiftrightunsigned("fp", BITS - lead).bitwiseXOR(F.col("mask").cast("bigint")).alias("bucket"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now = None

        def done() -> pa.RecordBatch:
            found = bucket_links(np.sort(np.concatenate(held)).view(np.uint64), now, lead, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(found[:, i]).view(np.int64)) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            buckets = batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.append(0, np.flatnonzero(buckets[1:] != buckets[:-1]) + 1)
            for i, j in zip(cuts, np.append(cuts[1:], len(buckets)), strict=True):
                if i == j:
                    continue
                if now is not None and buckets[i] != now:
                    yield done()
                    held = []
                now = int(buckets[i])
                held.append(fps[i:j])
        if held:
            yield done()

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Add `fingerprint` (signed long) and `component_id` (the least id that links reach) to every row."""
    marked = staged(fingerprint(docs, words, text_col), "fingerprints")
    return with_components(marked, radius, id_col)


def with_components(marked: DataFrame, radius: int, id_col: str) -> DataFrame:
    classes = staged(marked.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "classes")
    found = components(links_within(classes.select("fingerprint"), radius))
    named = classes.join(found, classes.fingerprint == found.node, "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = named.join(names, "component").select(F.col("fingerprint").alias("_tl_fp"), "component_id")
    return with_columns(marked.join(by_class, F.col("fingerprint") == F.col("_tl_fp")), {
        "component_id": by_class["component_id"]}).drop("_tl_fp")


def signed(docs: DataFrame, words: int, text_col: str) -> DataFrame:
    """Add the fingerprint (_tl_fp), the hash of the set of shingles (_tl_set) and its band keys (_tl_keys) of each text."""
    send_package(docs)
    kind = pa.struct([("fp", pa.int64()), ("set", pa.int64()), ("keys", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<fp: bigint, set: bigint, keys: array<bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            done = [pa.array([], kind)]
            for a, b in blocks(column):
                hashes, sizes = shingles(strings_of(column[a:b]), words)
                done.append(pa.StructArray.from_arrays([
                    pa.array(majority_bits(hashes, sizes).view(np.int64)), pa.array(set_hashes(hashes, sizes).view(np.int64)),
                    pa.array(band_keys(hashes, sizes), pa.list_(pa.int64()))], fields=list(kind)))
            yield pa.concat_arrays(done)

    marked = with_columns(docs, {"_tl_sign": run(F.col(text_col))})
    sign = F.col("_tl_sign")
    return with_columns(marked, {"_tl_fp": sign["fp"], "_tl_set": sign["set"], "_tl_keys": sign["keys"]}).drop("_tl_sign")


def first_of_each(docs: DataFrame, words: int = 5, radius: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of docs without near duplicates: of each component the row of its least id stays, once. Rows with the same id
    and unlike texts are in components of their own.

    Texts are linked whose fingerprints are within the radius or whose sets of shingles reach `shingle_sets.SIMILARITY`.
    Rows that have no id, or whose component has no named row, all stay.
    """
    marked = staged(signed(docs, words, text_col), "signatures")

    def shingled(nodes: DataFrame) -> DataFrame:
        @F.arrow_udf("array<bigint>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in batches:
                done = []
                for a, b in blocks(column):
                    hashes, sizes = shingles(strings_of(column[a:b]), words)
                    done += [np.unique(own.view(np.int64)) for own in np.split(hashes, np.cumsum(sizes)[:-1])]
                yield pa.array(done, pa.list_(pa.int64()))

        texts = marked.select(F.col("_tl_set").alias("node"), F.col(text_col).alias("_text"))
        return texts.join(nodes, "node", "left_semi").dropDuplicates(["node"]).select("node", run("_text").alias("shingles"))

    nodes = marked.groupBy("_tl_set").agg(F.first("_tl_keys").alias("keys")).withColumnRenamed("_tl_set", "node")
    # Fingerprints are nodes too, which hold the sets together that have them.
    of_fp = [F.xxhash64(F.lit("fp"), F.col(c)) for c in ("_tl_fp", "a", "b")]
    links = (
        marked.select("_tl_set", of_fp[0]).distinct()
        .union(links_within(marked.select("_tl_fp").distinct(), radius).select(*of_fp[1:]))
        .union(similar_links(nodes, shingled))
    )
    found = components(links).select(F.col("node").alias("_tl_set"), F.col("component").alias("_tl_component"))
    classes = marked.groupBy("_tl_set").agg(F.min(id_col).alias("_tl_first")).join(found, "_tl_set")
    least = classes.groupBy("_tl_component").agg(F.min("_tl_first").alias("_tl_least"))
    named = classes.join(least, "_tl_component").select("_tl_set", "_tl_least", "_tl_component")
    rows = marked.join(named, "_tl_set")
    unnamed = F.col(id_col).isNull() | F.col("_tl_least").isNull()
    once = rows.where(F.col(id_col) == F.col("_tl_least")).dropDuplicates(["_tl_component"])
    return once.unionByName(rows.where(unnamed)).select(*docs.columns)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = staged(fingerprint(docs).drop("text"), "fingerprints")
    return with_components(marked, 4, "doc_id").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
