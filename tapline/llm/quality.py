"""Quality classifier: supervised subword embeddings.

A text is the mean of the vectors of its features: each word and each three and four byte string, hashed to a fixed
number of buckets. A softmax over that mean gives the label. Vectors and weights are learned by stochastic gradient
descent in numpy, in one task, on at most `per_label` labelled rows of each label (the only bounded sample here).
Because the mean is linear, a learned model is one number per bucket and label pair; scoring adds those numbers up over
every whole text, so its cost is that of reading the text.

Null, empty and blank texts have no features and get the share of label 1 that the model learned as its bias. Labels
other than 0 and 1, null ids and ids with both labels teach nothing. Without labels of both kinds the score is that share
(one half without any). Repeated rows score alike; an input column with the name of a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapline.llm.common import blocks, bytes_of, crc_of_id, send_package, table, with_columns

BUCKET_BITS = 17
# Bytes of text whose features are made together: each takes some hundred bytes of room in the worker meanwhile.
TOGETHER = 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKET_BITS)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))


@dataclass(frozen=True)
class Settings:
    """`per_label`: rows of each label that teach; the rest sets the descent."""

    per_label: int = 2000
    dimensions: int = 16
    epochs: int = 5
    rate: float = 2.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Evidence for label 1 by bucket, and the bias."""

    evidence: np.ndarray
    bias: float


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of some texts (bytes and row starts), and the text of each feature."""
    n = len(data)
    text = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    space = (data == 32) | ((data >= 9) & (data <= 13))
    wide = np.where(space, 32, data).astype(np.uint64)
    kinds, owners = [], []
    for size, salt in ((3, 1), (4, 2)):
        if n < size:
            continue
        code = np.full(n - size + 1, salt, np.uint64)
        for i in range(size):
            code = (code << np.uint64(8)) | wide[i:n - size + 1 + i]
        blank = sum(32 << 8 * i for i in range(size)) + (salt << 8 * size)
        inside = (text[:n - size + 1] == text[size - 1:]) & (code != np.uint64(blank))
        kinds.append((code[inside] * _ODD) >> _SHIFT)
        owners.append(text[:n - size + 1][inside])
    begins = ~space
    begins[1:] &= space[:-1] | (text[1:] != text[:-1])
    first = np.flatnonzero(begins)
    if len(first):
        # Spaces before a word's successor are part of its span, with no weight.
        span = np.diff(np.append(first, n))
        place = np.arange(first[0], n) - np.repeat(first, span)
        weighed = np.where(space[first[0]:], 0, wide[first[0]:]) * _POWERS[place & 63]
        kinds.append((np.add.reduceat(weighed, first - first[0]) * _ODD) >> _SHIFT)
        owners.append(text[first])
    if not kinds:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(kinds).astype(np.int64), np.concatenate(owners)


def learn(rows: list[tuple[str, int]], settings: Settings) -> Model:
    """Descend over the rows in a seeded order; the result depends on the rows alone."""
    labels = np.array([label for _, label in rows], np.int64)
    share = float(labels.mean()) if len(rows) else 0.5
    if not len(rows) or labels.min() == labels.max():
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(share / (1 - share))))
    bags = []
    for text, _ in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        buckets, counts = np.unique(features(raw, np.array([0, len(raw)]))[0], return_counts=True)
        bags.append((buckets, (counts / max(1, counts.sum())).astype(np.float32)))
    chance = np.random.default_rng(settings.seed)
    vectors = chance.uniform(-1, 1, (1 << BUCKET_BITS, settings.dimensions)).astype(np.float32) / settings.dimensions
    weights, bias = np.zeros((settings.dimensions, 2), np.float32), np.zeros(2, np.float32)
    # Both labels weigh the same however many rows each has.
    balance = len(rows) / 2 / np.bincount(labels, minlength=2)
    step, steps = 0, settings.epochs * len(rows)
    for _ in range(settings.epochs):
        for i in chance.permutation(len(rows)):
            rate = settings.rate * (1 - step / steps) * balance[labels[i]]
            step += 1
            buckets, share_of = bags[i]
            mean = share_of @ vectors[buckets]
            scores = mean @ weights + bias
            push = np.exp(scores - scores.max())
            push /= push.sum()
            push[labels[i]] -= 1
            back = weights @ push
            weights -= rate * np.outer(mean, push)
            bias -= 0.1 * rate * push
            # A step per feature of full size, as each is a row of its own in the sum that the mean is.
            vectors[buckets] -= (rate * share_of / share_of.max(initial=1e-9))[:, None] * back
    gap = weights[:, 1] - weights[:, 0]
    return Model((vectors @ gap).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), label_col: str = "quality") -> Model:
    """Learn from the rows of `labels` (doc_id and the label) and their texts.

    The first `per_label` ids of each label in order of a hash of the id teach; their number bounds the broadcast, the
    task that learns and the model that comes back.
    """
    send_package(docs)
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).groupBy("doc_id")
        .agg(F.min(label_col).alias("_low"), F.max(label_col).alias("_high")).where("_low = _high")
    )
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn(
        "_hash", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    # Two of these rows; they tell which share of the hashes holds twice as many ids as are wanted.
    share = {r._low: min(1.0, 2 * settings.per_label / r.n) for r in known.groupBy("_low").agg(F.count("*").alias("n")).collect()}
    near = F.lit(False)
    for label, part in share.items():
        near |= (F.col("_low") == label) & (F.col("_hash") < int(part * (1 << 40)))
    chosen = (
        known.where(near)
        .withColumn("_place", F.row_number().over(W.partitionBy("_low").orderBy("_hash", "doc_id")))
        .where(F.col("_place") <= settings.per_label).select("doc_id", F.col("_low").cast("int").alias("_label"))
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taught = sorted((i, text or "", label) for b in batches for i, text, label in zip(
            *(b.column(k).to_pylist() for k in range(3)), strict=True))
        model = learn([(text, label) for _, text, label in taught], settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.evidence.tobytes()], pa.binary()), pa.array([model.bias])], ["evidence", "bias"])

    found = rows.repartition(1).mapInArrow(run, "evidence binary, bias double").head()
    if found is None:
        return learn([], settings)
    return Model(np.frombuffer(bytes(found.evidence), np.float32), found.bias)


def probabilities(texts: pa.Array, model: Model) -> pa.Array:
    """The probability of label 1 of each text."""
    done = [np.zeros(0)]
    for start, stop in blocks(texts, TOGETHER):
        buckets, text = features(*bytes_of(texts[start:stop]))
        total = np.bincount(text, model.evidence[buckets], stop - start)
        mean = total / np.maximum(1, np.bincount(text, minlength=stop - start))
        done.append(1 / (1 + np.exp(-np.clip(mean + model.bias, -60, 60))))
    return pa.array(np.concatenate(done))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add the probability of label 1 of each whole text."""
    send_package(docs)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield probabilities(column, model)

    return with_columns(docs, {score_col: run(F.col(text_col))})


def teaching(labels: DataFrame) -> DataFrame:
    """Label rows that may teach: the remainder of the id's checksum by 3 is not 1."""
    return labels.where(crc_of_id("doc_id") % 3 != 1)


def scored(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted for all rows of docs."""
    model = fit(docs, teaching(labels), settings)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(crc_of_id("doc_id") % 3 == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
