"""Repeated passages by collinear chaining of shared k-mer seeds.

Words are runs of letters and digits in lower case. Seeds are the runs of `K` words that winnowing picks: the least hash of
each `WINDOW` neighbouring runs, so any exact stretch of K + WINDOW - 1 words that two texts share gives both the same
seed. Per seed the texts that hold it are linked to the first of them (in order of a text hash), which is as many links as
occurrences; up to `FEW` texts are linked pair by pair as well. Seeds of one text alone go no further. The seeds that a text
shares with another are chained:
in order in both texts, each link costs by the gap it leaves, and the best predecessor comes from a Fenwick tree over the
other text's positions. Chains are aligned word by word (local, in a band around the chain, with a margin at both ends),
and what the best alignment leaves of a chain is aligned again, which gives the fuzzy passages; overlapping and neighbouring stretches of a text, from whatever partners, add up to
passages, and those of `PASSAGE` words or more are kept.

Where more texts share a seed, or a text holds it twice, the first holders of a passage's seeds may each be another text
that has little else of it. There all runs of `PASSAGE` words are compared as well: of each, every place is linked to the
first text with the same run. Equal runs are one class, so no exact repetition is lost, however many texts hold its seeds.

Edited passages of such seeds are found by pairs of seeds: of all seeds of a text no more than `REACH` words apart, one of
which many texts hold or a text holds twice, those places that lie in no stretch yet. They are linked to every text that
holds the same pair, where these are few. Where they are many, they are linked to the first and the last one, and so among
those that have the pair at the same distance, and with the same seeds on both sides of it. Up to `K` words said again and again make no pair with
themselves: such a run counts where `PASSAGE` words are equal, or with what stands beside it.
Stretches of whatever partners, also short ones, link passages: those linked directly or through others have one
passage_class.

Equal texts are one class, named by the least id. Rows come for class representatives, and one row for each further member
against its representative. Texts are fetched only for the stretches of chains; a text with very many chains is fetched in
several parts.

Null, empty and short texts have no passage. Texts are told apart by a 64-bit hash. Rows with a null id give rows with a
null id. An empty table gives an empty one; results hold ids and places only, so no other column can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapline.llm.common import blocks, drop_staged, send_package, staged, table, word_hashes
from tapline.llm.components import components

K, WINDOW, PASSAGE = 6, 10, 50
# Texts of a seed up to which all of them are linked; of more each is linked to the first.
FEW = 8
# Words between the starts of two seeds of a pair: the seeds of a stretch that are further apart have others between them.
REACH = 50
# Price of a word of gap, least words of a chain, words of margin, band beside the chain, words between joined stretches.
GAP, CHAIN, MARGIN, BAND, JOIN = 0.05, 12, 20, 24, 12
_PARTS = 16
# Alignments that a task does side by side, and words of them that it lays out at once.
SIDE_BY_SIDE, AT_ONCE = 256, 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def seeds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, position and hash of the chosen runs of each text."""
    words, sizes = word_hashes(texts)
    # Each text is followed by room, so that no window reaches the next one.
    starts = np.cumsum(np.append(0, sizes + WINDOW + K))
    hashes = np.zeros(starts[-1], np.uint64)
    hashes[np.arange(len(words)) + np.repeat(np.arange(len(texts)) * (WINDOW + K), sizes)] = words
    n = len(hashes) - K + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = np.zeros(n, np.uint64)
    for i in range(K):
        run = run * _ODD + hashes[i:n + i]
    run = (run ^ (run >> np.uint64(31))) * _ODD
    run ^= run >> np.uint64(29)
    text = np.repeat(np.arange(len(texts)), sizes + WINDOW + K)[:n]
    place, many = np.arange(n) - starts[text], (sizes - K + 1)[text]
    run[place >= many] = _NEVER
    first = np.flatnonzero((place < many) & ((place == 0) | (place <= many - WINDOW)))
    first = first[first + WINDOW <= n]
    view = np.lib.stride_tricks.sliding_window_view(run, WINDOW) if n >= WINDOW else np.zeros((0, WINDOW), np.uint64)
    chosen = np.unique(first + view[first].argmin(axis=1)) if len(first) else first
    return text[chosen], place[chosen], run[chosen].view(np.int64)


def chains(here: np.ndarray, there: np.ndarray) -> list[np.ndarray]:
    """Disjoint chains of matches (positions in two texts), best first; each is the indices of its matches in order."""
    order = np.lexsort((-there, here))
    x, y = here[order].tolist(), there[order].tolist()
    rank = (np.searchsorted(np.unique(there), there[order]) + 1).tolist()
    size = max(rank)
    # Fenwick tree of the best (score + GAP * (x + y), match) over ranks of y.
    tree: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)
    score, before = [0.0] * len(x), [-1] * len(x)
    for i in range(len(x)):
        best, j = (float("-inf"), -1), rank[i] - 1
        while j > 0:
            if tree[j] > best:
                best = tree[j]
            j &= j - 1
        reach = best[0] - GAP * (x[i] + y[i])
        score[i] = K
        if reach > 0:
            # Runs that overlap add only the words that are new.
            p = best[1]
            score[i] = reach + min(K, x[i] - x[p], y[i] - y[p])
            before[i] = p
        entry, j = (score[i] + GAP * (x[i] + y[i]), i), rank[i]
        while j <= size:
            if entry > tree[j]:
                tree[j] = entry
            j += j & -j
    out, used = [], [False] * len(x)
    for i in sorted(range(len(x)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain and x[chain[0]] - x[chain[-1]] + K >= CHAIN:
            out.append(order[chain[::-1]])
    return out


def align_all(tasks: list[tuple[np.ndarray, np.ndarray, int, int]], price: int = 1) -> np.ndarray:
    """Of each (a, b, shift, band) the best local score (match 1, otherwise -price) within `band` of the diagonal
    b = a + shift, and where it ends in a and in b. Tasks of like band and length are aligned side by side."""
    out = np.zeros((len(tasks), 3), np.int64)
    order = sorted(range(len(tasks)), key=lambda t: (tasks[t][3], len(tasks[t][0])))
    while order:
        # Large tasks first, with as many of the next smaller ones as fit in memory.
        rows, width = max(1, len(tasks[order[-1]][0])), 2 * tasks[order[-1]][3] + 1
        many = max(1, min(SIDE_BY_SIDE, AT_ONCE // (rows + width)))
        here, order = order[-many:], order[:-many]
        rows = max(len(tasks[t][0]) for t in here)
        width = 2 * max(tasks[t][3] for t in here) + 1
        # Scores are at most the rows and fall by the price a place: short rows fit half the room.
        kind = np.int16 if max(rows, (width + 1) * price) < 1 << 14 else np.int64
        cost, gain = kind(price), kind(price + 1)
        a = np.full((rows, len(here)), -2, tasks[here[0]][0].dtype)
        # near[i + k] is b[i + shift - band + k].
        near = np.full((rows + width, len(here)), -1, a.dtype)
        bands = np.array([tasks[t][3] for t in here])
        starts = np.array([tasks[t][2] for t in here]) - bands
        for j, t in enumerate(here):
            x, y, start = tasks[t][0], tasks[t][1], int(starts[j])
            a[:len(x), j] = x
            lo, hi = max(0, start), min(len(y), start + rows + width)
            if hi > lo:
                near[lo - start:hi - start, j] = y[lo:hi]
        # A score of 0 beside the band is as good as none.
        inside = (np.arange(width)[:, None] <= 2 * bands).astype(kind) if (bands != bands[0]).any() else None
        row, step, less = (np.zeros((width, len(here)), kind) for _ in range(3))
        wide, ramp = len(here) > 64, (np.arange(width) * price).astype(kind)[:, None]
        best, ends = np.zeros(len(here), np.int64), np.zeros((len(here), 2), np.int64)
        for i in range(rows):
            row -= cost
            np.multiply((near[i:i + width] == a[i]).view(np.int8), gain, out=step)
            step += row
            np.maximum(step[:-1], row[1:], out=step[:-1])
            np.maximum(step, 0, out=step)
            # Gaps of any length along the row: as sums of 1, 2, 4, ... places, or by a running maximum where few stand side by side.
            far = 1
            while far < width and wide:
                np.subtract(step[:-far], kind(far * price), out=less[far:])
                np.maximum(step[far:], less[far:], out=step[far:])
                far *= 2
            if not wide:
                step += ramp
                np.maximum.accumulate(step, axis=0, out=step)
                step -= ramp
            row, step = step, row
            if inside is not None:
                row *= inside
            top = row.max(axis=0)
            if len(better := np.flatnonzero(top > best)):
                best[better] = top[better]
                ends[better, 0] = i + 1
                ends[better, 1] = i + 1 + starts[better] + row[:, better].argmax(axis=0)
        out[here, 0], out[here, 1:] = best, ends
    return out


def stretches_of(tasks: list[tuple[np.ndarray, np.ndarray, int, int]],
                 price: int = 1) -> list[tuple[int, int, int, int, int]]:
    """Of each (a, b, shift, band): score, and start and stop in a and in b, of the best local alignment in the band."""
    ends = align_all(tasks, price).tolist()
    back = align_all([(a[:xe][::-1], b[:ye][::-1], ye - xe - shift, band)
                      for (a, b, shift, band), (_, xe, ye) in zip(tasks, ends, strict=True)], price).tolist()
    return [(score, xe - xs, xe, ye - ys, ye) for (score, xe, ye), (_, xs, ys) in zip(ends, back, strict=True)]


def all_stretches(tasks: list[tuple[np.ndarray, np.ndarray, int, int]]) -> list[list[tuple[int, int, int, int, int]]]:
    """Of each (a, b, shift, band) all stretches of `CHAIN` words and a third of matches (score, start and stop in a, in b).

    What lies before and behind the best alignment is aligned again, until nothing of `CHAIN` words can be left. One that
    bridges more than it matches is aligned again at a higher price of unequal words, so that its dense parts stand alone.
    """
    out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in tasks]
    # Task, begin and end of the rest in a and in b, by price.
    left = {1: [(t, 0, len(a), 0, len(b)) for t, (a, b, _, _) in enumerate(tasks)]}
    while left:
        price = min(left)
        todo = [r for r in left.pop(price) if min(r[2] - r[1], r[4] - r[3]) >= CHAIN / 3
                and max(r[2] - r[1], r[4] - r[3]) >= CHAIN]
        found = stretches_of([(tasks[t][0][x0:x1], tasks[t][1][y0:y1], tasks[t][2] + x0 - y0, tasks[t][3])
                              for t, x0, x1, y0, y1 in todo], price)
        for (t, x0, x1, y0, y1), (score, xs, xe, ys, ye) in zip(todo, found, strict=True):
            longest = max(xe - xs, ye - ys)
            if score < CHAIN / 3:
                continue
            xs, xe, ys, ye = xs + x0, xe + x0, ys + y0, ye + y0
            left.setdefault(1, []).extend([(t, x0, xs, y0, ys), (t, xe, x1, ye, y1)])
            if longest < CHAIN:
                continue
            if score < longest / 3:
                left.setdefault(2 * price, []).append((t, xs, xe, ys, ye))
            elif price > 1:
                left[1].append((t, xs, xe, ys, ye))
            else:
                out[t].append((score, xs, xe, ys, ye))
    return out


def _chained(pairs: DataFrame) -> DataFrame:
    """(th, other, x0, x1, y0, y1, low, high) of the chains of each pair of texts; low and high bound y - x."""
    schema = "th bigint, other bigint, x0 int, x1 int, y0 int, y1 int, low int, high int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for th, other, m in zip(*(batch.column(i) for i in range(3)), strict=True):
                flat = m.values.flatten()
                x, y = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in flat)
                for chain in chains(x, y):
                    away = y[chain] - x[chain]
                    rows.append((th.as_py(), other.as_py(), x[chain[0]], x[chain[-1]] + K, y[chain[0]],
                                 y[chain[-1]] + K, away.min(), away.max()))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], pa.int64() if i < 2 else pa.int32())
                                              for i, c in enumerate(columns)], schema.replace(",", "").split()[::2])

    return pairs.mapInArrow(run, schema)


def _links(held: DataFrame) -> DataFrame:
    """(th, other, x, y): places of a seed in two texts, of rows (seed, th, x, other, y, n) with its first holder."""
    firsts = held.where(F.col("n").between(3, FEW)).groupBy("seed", F.col("th").alias("_other")).agg(F.min("x").alias("_y"))
    more = held.where(F.col("n").between(3, FEW)).select("seed", "th", "x", "other").join(firsts, "seed").where(
        "th > _other and _other != other")
    return held.where("th != other").select("th", "other", "x", "y").union(more.select("th", "_other", "x", "_y"))


def _regions(held: DataFrame) -> DataFrame:
    """(th, lo, hi): stretches of seeds that other texts hold too, with all runs of `PASSAGE` words that may be shared.

    Such a run holds seeds no more than `WINDOW` places apart, from its first `WINDOW` places to its last ones. Where all
    seeds are in few texts, and once in each, the links have every pair.
    """
    order = W.partitionBy("th").orderBy("x")
    near = F.col("x") - F.lag("x").over(order) <= WINDOW
    return (
        held.select("th", "x", ((F.col("n") > FEW) | (F.col("most") > 1)).alias("many"))
        .withColumn("new", F.when(near, 0).otherwise(1)).withColumn("nth", F.sum("new").over(order))
        .groupBy("th", "nth").agg(F.min("x").alias("first"), F.max("x").alias("last"), F.max("many").alias("many"))
        .where(F.col("many") & (F.col("last") - F.col("first") >= PASSAGE - K - 2 * (WINDOW - 1)))
        .select("th", F.greatest(F.lit(0), F.col("first") - (WINDOW - 1)).alias("lo"),
                (F.col("last") + K + WINDOW - 1).alias("hi"))
    )


def _cut(numbered: DataFrame, regions: DataFrame, texts: DataFrame) -> DataFrame:
    """(th, chain, side, from, words) of both sides (a, b) of the chains and of the regions (r)."""
    def side(rows: DataFrame, which: str, th: str, lo: str, hi: str, margin: int) -> DataFrame:
        return rows.select(F.col(th).alias("_th"), F.pmod("chain", F.lit(_PARTS)).alias("part"), F.struct(
            "chain", F.lit(which).alias("side"), F.greatest(F.lit(0), F.col(lo) - margin).alias("from"),
            (F.col(hi) + margin).alias("to")).alias("piece"))

    named = regions.withColumn("chain", F.xxhash64("th", "lo"))
    pieces = side(numbered, "a", "th", "x0", "x1", MARGIN).union(side(numbered, "b", "other", "y0", "y1", MARGIN)).union(
        side(named, "r", "th", "lo", "hi", 0)).groupBy("_th", "part").agg(F.collect_list("piece").alias("pieces"))
    return (
        texts.join(pieces, "_th").select("_th", F.split("_norm", " ").alias("words"), F.explode("pieces").alias("p"))
        .select(F.col("_th").alias("th"), "p.chain", "p.side", F.col("p.from").alias("from"), F.array_join(F.slice(
            "words", F.col("p.from") + 1, F.col("p.to") - F.col("p.from")), " ").alias("words"))
    )


def long_runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, position and hash of every run of `PASSAGE` words."""
    words, sizes = word_hashes(texts)
    n = len(words) - PASSAGE + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = np.zeros(n, np.uint64)
    for i in range(PASSAGE):
        run = run * _ODD + words[i:n + i]
    run = (run ^ (run >> np.uint64(31))) * _ODD
    run ^= run >> np.uint64(29)
    text = np.repeat(np.arange(len(texts)), sizes)[:n]
    place = np.arange(n) - (np.cumsum(sizes) - sizes)[text]
    whole = place + PASSAGE <= sizes[text]
    return text[whole], place[whole], run[whole].view(np.int64)


def _exact(regions: DataFrame) -> DataFrame:
    """(th, start, stop, other, other_start, other_stop, score) of equal runs, of rows (th, from, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            th, begin = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
            for start, stop in blocks(batch.column(2)):
                text, place, runs = long_runs(batch.column(2)[start:stop])
                yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(th[start:stop][text]), pa.array(
                    (begin[start:stop][text] + place).astype(np.int32))], ["run", "th", "x"])

    runs = staged(regions.select("th", "from", "words").mapInArrow(run, "run bigint, th bigint, x int"), "long-runs")
    shared = runs.groupBy("run").agg(F.min(F.struct("th", "x")).alias("first"), F.max(F.struct("th", "x")).alias(
        "last")).where("first.th < last.th")
    # The first text's own places are linked to the last text.
    met = runs.join(shared, "run").withColumn("o", F.when(F.col("th") == F.col("first.th"), F.col("last")).otherwise(
        F.col("first"))).select("th", "x", F.col("o.th").alias("other"), F.col("o.x").alias("y"))
    order = W.partitionBy("th", "other", "away").orderBy("x")
    begun = met.withColumn("away", F.col("y") - F.col("x")).withColumn(
        "new", F.when(F.col("x") - F.lag("x").over(order) <= 1, 0).otherwise(1))
    return begun.withColumn("nth", F.sum("new").over(order)).groupBy("th", "other", "away", "nth").agg(
        F.min("x").alias("start"), (F.max("x") + PASSAGE).alias("stop")).select(
        "th", "start", "stop", "other", (F.col("start") + F.col("away")).alias("other_start"),
        (F.col("stop") + F.col("away")).alias("other_stop"), F.lit(1.0).alias("score"))


def _fresh(exact: DataFrame, aligned: DataFrame) -> DataFrame:
    """Of the equal runs those that cover what the alignments of the pair do not, the later text first.

    Runs of repetitive texts meet at many offsets. Of those that begin in the same half passage, the first one and the one
    that reaches furthest cover all places of the others.
    """
    near = W.partitionBy("th", "other", F.floor(F.col("start") / (PASSAGE // 2)))
    ends = exact.withColumn("first", F.row_number().over(near.orderBy("start", F.desc("stop")))).withColumn(
        "furthest", F.row_number().over(near.orderBy(F.desc("stop"), "start"))).where("first = 1 or furthest = 1")
    ahead = F.col("th") > F.col("other")

    def turned(name: str, facing: str) -> Column:
        return F.when(ahead, F.col(name)).otherwise(F.col(facing)).alias(name)

    runs = ends.select(turned("th", "other"), turned("start", "other_start"), turned("stop", "other_stop"), turned(
        "other", "th"), turned("other_start", "start"), turned("other_stop", "stop"), "score").distinct().alias("e")
    known, pair = aligned.alias("k"), "e.th = k.th and e.other = k.other"
    here = F.expr(f"{pair} and e.start >= k.start and e.stop <= k.stop")
    there = F.expr(f"{pair} and e.other_start >= k.other_start and e.other_stop <= k.other_stop")
    return runs.join(known, here, "left_anti").union(runs.join(known, here, "left_semi").join(known, there, "left_anti"))


def _aligned(numbered: DataFrame, cut: DataFrame) -> DataFrame:
    """(th, start, stop, other, other_start, other_stop, score) of the stretches that chains align to."""
    sides = cut.where("side != 'r'").groupBy("chain").agg(
        F.max(F.when(F.col("side") == "a", F.struct("from", "words"))).alias("a"),
        F.max(F.when(F.col("side") == "b", F.struct("from", "words"))).alias("b"))
    rows = numbered.join(sides, "chain").select(
        "th", "other", "low", "high", F.col("a.from").alias("af"), F.col("b.from").alias("bf"), "a.words",
        F.col("b.words").alias("others"))
    schema = "th bigint, start int, stop int, other bigint, other_start int, other_stop int, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, number, tasks = [], {}, []
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for _, _, low, high, af, bf, a, b in rows:
                x, y = (np.array([number.setdefault(w, len(number)) for w in words.split()], np.int32) for words in (a, b))
                tasks.append((x, y, (low + high) // 2 - bf + af, BAND + (high - low + 1) // 2))
            for (th, other, _, _, af, bf, _, _), several in zip(rows, all_stretches(tasks), strict=True):
                out += [(th, af + xs, af + xe, other, bf + ys, bf + ye, score / max(xe - xs, ye - ys))
                        for score, xs, xe, ys, ye in several]
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             schema.replace(",", "").split()[::2])

    return rows.repartition("th", "other").mapInArrow(run, schema)


def _whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of sorted rows, cut so that all rows of a text (column 0) come together."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        now = now if kept is None else [np.concatenate(two) for two in zip(kept, now, strict=True)]
        fresh = np.flatnonzero(now[0][1:] != now[0][:-1])
        cut = fresh[-1] + 1 if len(fresh) else 0
        if cut:
            yield [c[:cut] for c in now]
        kept = [c[cut:] for c in now]
    if kept is not None and len(kept[0]):
        yield kept


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """One hash of several numbers a row, in their order."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ part.astype(np.int64).view(np.uint64)) * _ODD
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def seed_pairs(th: np.ndarray, x: np.ndarray, seed: np.ndarray, many: np.ndarray, reach: np.ndarray) -> list[np.ndarray]:
    """(pair, left, right, th, x, x2, open) of the pairs of seeds of whole texts, rows sorted by text and place.

    A seed makes a pair with the next place of each seed that follows within `REACH` words, up to its own next one, if one of
    both is held by many and they can make a chain. left and right are the seeds beside it. A pair is open if it ends
    beyond `reach`, where the piece ends that holds its first seed.
    """
    n = len(th)
    text = np.cumsum(np.append(0, th[1:] != th[:-1]))
    order = np.lexsort((np.arange(n), seed, text))
    a, b = order[:-1], order[1:]
    same = (seed[a] == seed[b]) & (text[a] == text[b])
    before, after = np.full(n, -1), np.full(n, n)
    before[b[same]], after[a[same]] = a[same], b[same]
    side = np.concatenate([[0], seed, [0]])
    left = np.where(np.append(True, text[1:] != text[:-1]), 0, side[:n])
    right = np.where(np.append(text[1:] != text[:-1], True), 0, side[2:])
    firsts, lasts = [], []
    for step in range(1, min(n, REACH + 1)):
        i = np.flatnonzero((text[step:] == text[:-step]) & (x[step:] - x[:-step] <= REACH))
        if not len(i):
            break
        j = i + step
        wanted = (many[i] | many[j]) & (before[j] <= i) & (after[i] >= j) & (x[j] - x[i] >= CHAIN - K)
        wanted &= (seed[i] != seed[j]) | (x[j] - x[i] > K)
        firsts.append(i[wanted])
        lasts.append(j[wanted])
    i, j = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (firsts, lasts))
    return [_mixed(seed[i], seed[j]), left[i], right[j], th[i], x[i], x[j], reach[i] < x[j] + K]


def _pairs(held: DataFrame, pieces: DataFrame) -> DataFrame:
    """The rows of `seed_pairs` of all texts."""
    none = F.lit(0).cast("long")
    rows = held.select("th", "x", "seed", ((F.col("n") > FEW) | (F.col("most") > 1)).alias("many"), F.lit(0).alias("stop")).union(
        pieces.select("th", "passage_start", none, F.lit(False), "passage_stop"))
    schema = "pair bigint, left bigint, right bigint, th bigint, x int, x2 int, open boolean"
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for th, x, seed, many, stop in _whole_texts(batches):
            # How far the pieces go that begin no later, text by text.
            beyond = np.cumsum(np.append(0, th[1:] != th[:-1])) << 32
            reach = np.maximum.accumulate(beyond + stop) - beyond
            own = stop == 0
            columns = seed_pairs(*(c[own] for c in (th, x.astype(np.int64), seed, many, reach)))
            for at in range(0, len(columns[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[at:at + (1 << 16)]).cast(k) for c, k in zip(
                    columns, kinds, strict=True)], schema.replace(",", "").split()[::2])

    return rows.repartition("th").sortWithinPartitions("th", "x", F.desc("stop")).mapInArrow(run, schema)


def _partners(rows: DataFrame, key: str) -> DataFrame:
    """(th, x, x2, other, y, y2): of open rows the first place with the same key in another text: of all texts where they
    are few, else of the first and the last one."""
    holders = rows.groupBy(key, "th").agg(F.min(F.struct("x", "x2")).alias("at"))
    place = F.struct("th", "at.x", "at.x2")
    groups = holders.groupBy(key).agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last")).where(
        "n > 1")
    asked = rows.where("open").join(groups, key)
    two = asked.where(F.col("n") > FEW).withColumn("o", F.explode(F.array("first", "last"))).where("th != o.th").select(
        "th", "x", "x2", F.col("o.th").alias("other"), F.col("o.x").alias("y"), F.col("o.x2").alias("y2"))
    every = holders.select(key, F.col("th").alias("other"), F.col("at.x").alias("y"), F.col("at.x2").alias("y2"))
    few = asked.where(F.col("n") <= FEW).select(key, "th", "x", "x2").join(every, key).where("th != other")
    return two.union(few.select(*two.columns))


def _linked_again(rows: DataFrame) -> DataFrame:
    """(th, other, m): places of the open pairs of seeds in two texts, as `_chained` takes them."""
    hot = rows.select("pair", "th").distinct().groupBy("pair").count().where(f"count > {FEW}").select("pair")
    closer = rows.join(hot, "pair").withColumn("near", F.explode(F.array(
        F.xxhash64("pair", F.col("x2") - F.col("x")), F.xxhash64("pair", "left", "right"))))
    found = _partners(rows, "pair").union(_partners(closer, "near"))
    ahead = F.col("th") > F.col("other")
    turned = found.select(
        F.greatest("th", "other").alias("th"), F.least("th", "other").alias("other"), F.explode(F.array(
            F.struct(F.when(ahead, F.col("x")).otherwise(F.col("y")).alias("x"), F.when(ahead, F.col("y")).otherwise(F.col("x")).alias("y")),
            F.struct(F.when(ahead, F.col("x2")).otherwise(F.col("y2")).alias("x"),
                     F.when(ahead, F.col("y2")).otherwise(F.col("x2")).alias("y")))).alias("p"))
    return turned.groupBy("th", "other").agg(F.collect_set("p").alias("m")).where("size(m) > 1")


def _pieces(stretches: DataFrame) -> DataFrame:
    """(th, passage_start, passage_stop): stretches of a text joined where they overlap or nearly meet."""
    places = stretches.select("th", "start", "stop").union(
        stretches.select("other", "other_start", "other_stop")).distinct()
    order = W.partitionBy("th").orderBy("start", "stop")
    upto = F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1))
    begun = places.withColumn("new", F.when(F.col("start") <= upto + JOIN, 0).otherwise(1))
    return begun.withColumn("nth", F.sum("new").over(order)).groupBy("th", "nth").agg(
        F.min("start").alias("passage_start"), F.max("stop").alias("passage_stop")).drop("nth")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, stop, other_id, other_start, other_stop, score, passage_start, passage_stop, passage_class), places
    in words.

    A row says that words start to stop of a document are, but for edits, those of the other one, and which repeated
    passage of the document they belong to. The score is the alignment's, 1 for an exact repetition. Passages of one
    passage_class are linked; not every pair of them has a row. Copies of a text have a class of their own.
    """
    send_package(docs)
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), F.col(text_col).alias("_text"))
    normal = texts.select("_th", normalised(F.col("_text")).alias("_norm"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in blocks(batch.column(1)):
                text, place, run = seeds(batch.column(1)[start:stop])
                th = batch.column(0)[start:stop].to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(run), pa.array(th[text]), pa.array(place.astype(np.int32))], ["seed", "th", "x"])

    occurrences = staged(normal.mapInArrow(pick, "seed bigint, th bigint, x int"), "seeds")
    shared = occurrences.groupBy("seed").agg(F.min(F.struct("th", "x")).alias("first"), F.max("th").alias("last")).where(
        "first.th < last").select("seed", F.col("first.th").alias("other"), F.col("first.x").alias("y"))
    met = staged(occurrences.join(shared, "seed").distinct(), "shared-seeds")
    holders = met.groupBy("seed", "th").agg(F.count("*").alias("times")).groupBy("seed").agg(
        F.count("*").alias("n"), F.max("times").alias("most"))
    held = staged(met.join(holders, "seed"), "held-seeds")
    drop_staged(occurrences)
    drop_staged(met)
    pairs = _links(held).groupBy("th", "other").agg(F.collect_set(F.struct("x", "y")).alias("m")).where("size(m) > 1")
    numbered = staged(_chained(pairs).withColumn("chain", F.xxhash64("th", "other", "x0", "y0")), "chains")
    regions = staged(_regions(held), "regions")

    def words_of(chained: DataFrame, parts: DataFrame) -> DataFrame:
        ends = chained.select(F.col("th").alias("_th")).union(chained.select("other")).union(parts.select("th")).distinct()
        wanted = normal.join(ends, "_th", "left_semi").dropDuplicates(["_th"])
        return staged(_cut(chained, parts, wanted), "pieces")

    cut = words_of(numbered, regions)
    aligned = staged(_aligned(numbered, cut), "aligned")
    exact = staged(_exact(cut.where("side = 'r'")), "exact")
    drop_staged(cut)
    once = staged(aligned.union(_fresh(exact, aligned)), "stretches")
    # Places of seeds that many texts hold and that lie in no stretch yet.
    every = staged(_pairs(held, _pieces(once)), "seed-pairs")
    rows = staged(every.join(every.where("open").select("pair").distinct(), "pair", "left_semi"), "open-pairs")
    drop_staged(every)
    again = staged(_chained(_linked_again(rows)).withColumn("chain", F.xxhash64("th", "other", "x0", "y0")), "chains")
    more = staged(_aligned(again, words_of(again, regions.where("false"))), "aligned")
    known = [F.col(f"m.{c}") == F.col(f"k.{c}") for c in ("th", "other")] + [
        F.expr("m.start >= k.start and m.stop <= k.stop and m.other_start >= k.other_start and m.other_stop <= k.other_stop")]
    stretches = staged(once.union(more.alias("m").join(once.alias("k"), known, "left_anti")), "stretches")
    pieces = staged(_pieces(stretches), "passages")
    passages = pieces.where(F.col("passage_stop") - F.col("passage_start") >= PASSAGE)
    # Words are counted before rows meet their class, so that no text is shuffled for it.
    members = staged(texts.select("_id", "_th", F.regexp_count(F.lower("_text"), F.lit(r"[\p{L}\p{N}]+")).alias("words")), "members")
    classes = staged(members.groupBy("_th").agg(F.min("_id").alias("rep"), F.count("*").alias("n")), "classes")
    names = classes.select(F.col("_th"), "rep")
    both = stretches.select("*").union(stretches.select(
        "other", "other_start", "other_stop", "th", "start", "stop", "score"))
    node = F.xxhash64("th", "passage_start").alias("node")
    own = passages.select("*", node)
    facing = pieces.select(F.col("th").alias("other"), F.col("passage_start").alias("_from"), F.col(
        "passage_stop").alias("_to"), node.alias("facing"))
    inside = "start >= passage_start and stop <= passage_stop"
    # All equal runs link their passages, also those without a row.
    found = components(stretches.union(exact).join(pieces.select("*", node), "th").where(inside).join(facing, "other").where(
        "other_start >= _from and other_stop <= _to").select("node", "facing").distinct())
    placed = both.join(own, "th").where(inside)
    of_classes = (
        placed.join(found, "node", "left").withColumn("passage_class", F.coalesce("component", "node"))
        .join(names.select(F.col("_th").alias("th"), F.col("rep").alias("doc_id")), "th")
        .join(names.select(F.col("_th").alias("other"), F.col("rep").alias("other_id")), "other")
        .select("doc_id", "start", "stop", "other_id", "other_start", "other_stop", "score", "passage_start", "passage_stop",
                "passage_class")
    )
    zero = F.lit(0)
    copied = members.where(F.col("words") >= PASSAGE).join(classes.where("n > 1"), "_th").where(
        F.col("_id").isNull() | (F.col("_id") != F.col("rep"))).select(
        "_id", zero, "words", "rep", zero, "words", F.lit(1.0), zero, "words", F.xxhash64("_th"))
    return of_classes.union(copied)


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
