"""Pairs of texts whose sets of word shingles have a Jaccard similarity of at least `SIMILARITY`.

Candidates share one of `BANDS` keys of `ROWS` min-hashes each: a pair at a similarity of 0.8 is met with a probability of
0.99997, one at 0.9 practically always. Pairs of a bucket are verified by their exact shingle sets, skipping pairs that hang
together already; buckets with the same members are looked at once, and of buckets with more than `SET_TEXTS` members every
pair of parts has a task, so no member is dropped. Texts with the same set are one node, named by a 64-bit hash of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapline.llm.common import staged

SIMILARITY, BANDS, ROWS = 0.8, 20, 4
SET_TEXTS = 1000
_ODD = np.random.default_rng(3).integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_MASK = np.random.default_rng(4).integers(0, 1 << 64, BANDS * ROWS, np.uint64)


def set_hashes(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of the set of each run of `sizes` hashes; that of the empty set is 0."""
    out = np.zeros(len(sizes), np.uint64)
    for i, end in enumerate(np.cumsum(sizes).tolist()):
        own = np.unique(hashes[end - sizes[i]:end])
        out[i] = ((own ^ (own >> np.uint64(29))) * _ODD[0]).sum(dtype=np.uint64)
    return out


def band_keys(hashes: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    """The keys of each run of `sizes` hashes, none for an empty run."""
    rows = np.flatnonzero(sizes)
    out: list[list[int]] = [[] for _ in sizes]
    if not len(rows):
        return out
    first = (np.cumsum(sizes) - sizes)[rows]
    keys = np.zeros((len(rows), BANDS), np.uint64)
    for i in range(BANDS * ROWS):
        least = np.minimum.reduceat((hashes ^ _MASK[i]) * _ODD[i], first)
        band = i // ROWS
        keys[:, band] = (keys[:, band] ^ (least >> np.uint64(7))) * _ODD[i] + np.uint64(band)
    for row, own in zip(rows.tolist(), keys.view(np.int64).tolist(), strict=True):
        out[row] = own
    return out


def alike(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sorted sets reach the similarity."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def forest(sets: list[np.ndarray], similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links of a forest that spans all pairs of sets that are alike."""
    groups: list[list[int]] = []
    links = []
    for i, own in enumerate(sets):
        mine, others = [i], []
        for group in groups:
            j = next((j for j in group if alike(sets[j], own, similarity)), None)
            if j is None:
                others.append(group)
            else:
                links.append((i, j))
                mine = group + mine
        groups = [mine, *others]
    return links


def similar_links(nodes: DataFrame, shingled) -> DataFrame:
    """Links (a, b) of nodes (node, keys) that are alike; `shingled` gives (node, sorted shingles) of a table of nodes."""
    from tapline.llm.line_dedup import _runs

    keyed = staged(nodes.select("node", F.explode("keys").alias("key")), "bands")
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("own"))
    several = buckets.where("n > 1").groupBy("n", "own").agg(F.min("key").alias("key")).select(
        "key", F.ceil(F.col("n") / SET_TEXTS).cast("int").alias("parts"))
    members = staged(keyed.join(several, "key").select("key", "parts", "node"), "buckets")
    sets = staged(shingled(members.select("node").distinct()), "shingles")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    tasks = members.withColumn("part", part).select("key", "node", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.struct(F.least("part", j).alias("x"), F.greatest("part", j).alias("y")))).alias("p"))
    rows = tasks.join(sets, "node").select("key", "p.x", "p.y", "node", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _runs(batches, 3):
            node = np.concatenate([p.column(3).to_numpy(zero_copy_only=False) for p in parts])
            links = forest([s.values.to_numpy() for p in parts for s in p.column(4)])
            if links:
                a, b = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node").mapInArrow(
        run, "a bigint, b bigint")
