"""Fuzzy line deduplication: SimHash of normalised lines, pigeonhole blocks, edit similarity, one line per group.

Lines are normalised (lower case, digits as 0, anything but letters and digits as a blank), the lines of many texts at once,
by tables. Equal lines are one node, told apart by a 64-bit hash of their words. Nodes whose fingerprints over words differ in
at most `radius` of 64 bits are candidates: cut into m blocks, two such fingerprints agree in at least m - radius of them, so each node goes once to every choice of m - radius
blocks. More nodes mean more, finer blocks, which changes cost and not results.

A short line's fingerprint moves by some twelve bits where a fifth of its words is edited, which no choice of blocks can
meet. So nodes also meet where they share one of `BANDS` keys of `ROWS` min-hashes over words and their counts, if their
fingerprints differ in at most `WIDE` bits and their numbers of words allow it. An edit similarity of 0.8 leaves two thirds of the words of both lines in
common or more, which meets 92 of 100 such pairs; one word in ten edited (0.82 in common) meets 999 of 1,000.

A task compares the fingerprints of a bucket in blocks and keeps, for each, the sets that hang together there; those
near the first line of the bucket hang together without being compared. Sets with the same members are looked at once, and
only their lines' texts are fetched, by their bytes in the text. Sets with the same least line, which share most of their lines,
are one task's: a line gets its words and a pair is compared once there. The edit similarity over words is checked for many
pairs side by side, with a bit for each cell of a band, skipping pairs that are connected already, and verified links are joined
to components by Spark. Sets of more than `SET_LINES` lines are split
and every pair of parts has a task. Of each component the first occurrence stays (least document id, then line).

Blank lines (nothing left after normalising) stay. Null texts stay null. Rows that agree in id and text count as one
document and keep the same lines. Line ends are "\\n". An empty table gives an empty one; extra columns come along, those
with the names of result columns are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapline.llm.common import (
    blocks, bytes_of, drop_staged, majority_bits, row_key, send_package, staged, strings_of, table, with_columns,
    word_hashes,
)
from tapline.llm.components import components

RADIUS, SIMILARITY = 3, 0.8
# Bits in which lines that share a key of min-hashes may differ, keys of a line, min-hashes of a key.
WIDE, BANDS, ROWS = 20, 12, 4
# Lines of a bucket aimed at, and lines of a candidate set that one task checks alone.
BUCKET, SET_LINES = 64, 4000
# Bytes of text whose words are hashed together.
TOGETHER = 1 << 17
# Words of 64 bits that stand for a line's words.
MARKS = 8
# Words of a line up to which edit distances of many pairs are found side by side, so many pairs; pairs looked at together.
SHORT_LINE, SIDE_BY_SIDE, PAIRS_AT_ONCE = 512, 2048, 1 << 18
# Lines whose sets one task checks together, and the bytes of their texts.
LINES_AT_ONCE, TEXT_AT_ONCE = 30_000, 16 << 20
# Places of whole buckets that a task compares at once, lines whose places are packed together.
SET_ROWS, PACKED_LINES = 100_000, 30_000
# Bits of the number of words beside a bucket of 40 bits; more words count as so many.
_WORDS = 24
_MOST_WORDS = (1 << _WORDS) - 1

_ODD = np.random.default_rng(8).integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_MASK = np.random.default_rng(9).integers(0, 1 << 64, BANDS * ROWS, np.uint64)

_ASCII_FORM = bytes(c if chr(c).isalpha() or c == 10 else 48 if 48 <= c < 58 else 32 for c in range(128)) + bytes(range(128, 256))


@lru_cache(maxsize=1)
def _forms() -> np.ndarray:
    """What each code point of a text in lower case becomes: itself if a letter, a number or a line end, 0 if a digit, or a blank."""
    size = sys.maxunicode + 1
    forms = np.where(np.fromiter(map(str.isalnum, map(chr, range(size))), bool, size), np.arange(size, dtype=np.uint32), np.uint32(32))
    forms[10], forms[48:58] = 10, 48
    return forms


# The lowest bytes of 64 bits, from none to all eight.
_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def form_hashes(form: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a normal form begins, and a 64-bit hash of it, eight bytes of all words at a time."""
    view = np.frombuffer(form + b" " * 9, np.uint8)
    inside = view[:len(form) + 1] > 32
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    begin, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(view) - 7, "<u8", view, strides=(1,))
    hashes = (eight[begin] & _BYTES[np.minimum(size, 8)]) * _ODD[7]
    hashes ^= hashes >> np.uint64(32)
    some, done = np.flatnonzero(size > 8), 8
    while len(some):
        mix = (hashes[some] + (eight[begin[some] + done] & _BYTES[np.minimum(size[some] - done, 8)])) * _ODD[8]
        hashes[some] = mix ^ (mix >> np.uint64(29))
        done += 8
        some = some[size[some] > done]
    for shift in (30, 27):
        hashes = (hashes ^ (hashes >> np.uint64(shift))) * _ODD[9]
    return begin, hashes ^ (hashes >> np.uint64(31))


def normal_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the normal form of each line of some texts, and the number of words of each line."""
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = "\n".join(strings_of(texts)).lower()
    if joined.isascii():
        form = joined.encode().translate(_ASCII_FORM)
    else:
        form = _forms()[np.frombuffer(joined.encode("utf-32-le"), np.uint32)].tobytes().decode("utf-32-le").encode()
    begin, hashes = form_hashes(form)
    ends = np.flatnonzero(np.frombuffer(form, np.uint8) == 10)
    return hashes, np.diff(np.searchsorted(begin, ends), prepend=0, append=len(begin))


def counted_words(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The hashes with the n-th occurrence of a word in its line told apart from the others."""
    # Equal words of a line stand together in order of a mix of both.
    line = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    mixed = hashes ^ (line * _MASK[0])
    order = np.argsort(mixed)
    same = np.append(False, np.diff(mixed[order]) == 0) if len(order) else np.zeros(0, bool)
    place = np.arange(len(order))
    nth = np.empty(len(order), np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(same, 0, place))
    return hashes + nth * _ODD[0]


def band_keys(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The 32-bit keys of each line, a row each; lines must have words."""
    keys = np.zeros((len(sizes), BANDS), np.uint64)
    if len(sizes):
        words, first = counted_words(hashes, sizes), np.cumsum(sizes) - sizes
        mixed = np.empty_like(words)
        for i in range(BANDS * ROWS):
            np.multiply(np.bitwise_xor(words, _MASK[i], out=mixed), _ODD[i], out=mixed)
            least = np.minimum.reduceat(mixed, first)
            band = i // ROWS
            keys[:, band] = (keys[:, band] ^ (least >> np.uint64(7))) * _ODD[i] + np.uint64(band)
    return (keys >> np.uint64(32)).astype(np.uint32)


def fingerprints(lines: pa.Array) -> np.ndarray:
    """64-bit SimHash of each line in normal form over its words."""
    done = [majority_bits(*word_hashes(lines[a:b])) for a, b in blocks(lines, TOGETHER)]
    return np.concatenate([np.zeros(0, np.uint64), *done])


def line_hashes(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each line's words in their order; lines must have words."""
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(first, sizes).astype(np.uint64)
    mix = words + (place + np.uint64(1)) * _ODD[2]
    for shift in (32, 29):
        mix = (mix ^ (mix >> np.uint64(shift))) * _ODD[3]
    total = np.add.reduceat(mix ^ (mix >> np.uint64(32)), first) if len(first) else np.zeros(0, np.uint64)
    return (total ^ (total >> np.uint64(31))) * _ODD[4]


def signatures(texts: pa.Array) -> Iterator[pa.Array]:
    """The lines of each text that have words: number, first byte, bytes, hash, fingerprint, keys and number of words; some texts at a time."""
    for a, b in blocks(texts, TOGETHER):
        words, sizes = normal_words(texts[a:b])
        view, starts = bytes_of(texts[a:b])
        # Lines end before a line end and with their text, which comes first where both are at one place.
        ends = np.concatenate([starts[1:], np.flatnonzero(view == 10)])
        order = np.argsort(ends, kind="stable")
        ends, inner = ends[order], order >= b - a
        begin = np.append(0, ends[:-1] + inner[:-1])
        lines = np.diff(np.flatnonzero(~inner), prepend=-1)
        first = np.cumsum(lines) - lines
        some = sizes > 0
        number = (np.arange(len(sizes)) - np.repeat(first, lines))[some]
        start, size = (begin - np.repeat(starts[:-1], lines))[some], (ends - begin)[some]
        sizes = sizes[some]
        ends = np.arange(len(sizes) + 1, dtype=np.int32) * (4 * BANDS)
        rows = pa.StructArray.from_arrays([
            pa.array(number, pa.int32()), pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(line_hashes(words, sizes).view(np.int64)),
            pa.array(majority_bits(words, sizes).view(np.int64)),
            pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(band_keys(words, sizes))]),
            pa.array(sizes, pa.int32())], ["no", "start", "size", "h", "fp", "keys", "words"])
        yield pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(some))[np.append(first, len(some))], pa.int32()), rows)


def block_masks(count: int, radius: int) -> list[int]:
    """Bit masks of all choices of blocks, as many blocks as keep buckets small for so many lines."""
    for extra in range(1, 5):
        m = radius + extra
        if count / 2 ** (64 * extra / m) <= BUCKET:
            break
    edges = [round(64 * i / m) for i in range(m + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, extra)]


def unite(root: np.ndarray, at: np.ndarray, to: np.ndarray) -> None:
    """Join the trees of the rows of each pair; every row then has the last row of its tree as root."""
    while len(at):
        x, y = root[at], root[to]
        apart = x != y
        at, to, x, y = at[apart], to[apart], x[apart], y[apart]
        root[np.minimum(x, y)] = np.maximum(x, y)
        while len(deeper := np.flatnonzero(root[root] != root)):
            root[deeper] = root[root[deeper]]


def sets_of_buckets(bucket: np.ndarray, fps: np.ndarray, words: np.ndarray, radius: int, similarity: float) -> np.ndarray:
    """For each row (in order of bucket) a row of its bucket that stands for all it hangs together with; -1 if with none.

    Rows hang together when their fingerprints are within the radius and their numbers of words allow the similarity. Rows
    within half the radius of the first of their bucket are within the radius of each other, so they are taken together. The
    others are compared with all that come 1, 2, 3, ... places on, for as long as any bucket is that large.
    """
    ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)) if len(bucket) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(0, ends))
    first = np.repeat(ends - sizes, sizes)
    close = np.bitwise_count(fps ^ fps[first]) <= radius // 2
    # In each bucket what is not close comes first, so that it meets every other row.
    order = np.lexsort((close, first))
    fps, words, close, last = fps[order], words[order], close[order], np.repeat(ends, sizes)
    crowd = np.flatnonzero(close)
    root = np.arange(len(fps))
    # One root for the close rows of a bucket: its last row, as the first row of the bucket is always among them.
    root[crowd] = last[crowd] - 1
    here, step, met, waiting = np.flatnonzero(~close), 1, [], 0
    while len(here := here[here + step < last[here]]):
        at = here[np.bitwise_count(fps[here] ^ fps[here + step]) <= radius]
        longer = np.maximum(words[at], words[at + step])
        at = at[longer - np.minimum(words[at], words[at + step]) <= (1 - similarity) * longer + 1e-9]
        if len(at):
            met.append((at, at + step))
            waiting += len(at)
        if waiting > PAIRS_AT_ONCE:
            unite(root, *map(np.concatenate, zip(*met, strict=True)))
            met, waiting = [], 0
        step += 1
    if met:
        unite(root, *map(np.concatenate, zip(*met, strict=True)))
    joined = np.bincount(root, minlength=len(fps))[root] > 1
    out = np.full(len(fps), -1)
    out[order] = np.where(joined, order[root], -1)
    return out


def distance(a: list[str], b: list[str], most: int) -> int:
    """Edit distance of two word sequences by Hyyro's bit-parallel recurrence; any number above `most` if it is more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if not a:
        return len(b)
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    up, down = full, 0
    for word in b:
        same = places.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        rise, fall = (down | ~(diagonal | up)) << 1 | 1, (up & diagonal) << 1
        up, down = (fall | ~(diagonal | rise)) & full, rise & diagonal & full
    # The last column begins with all of b and goes up and down by one.
    return len(b) + up.bit_count() - down.bit_count()


def similar(a: list[str], b: list[str], similarity: float) -> bool:
    longest = max(len(a), len(b))
    most = int((1 - similarity) * longest + 1e-9)
    # Replacing word by word is one way of editing.
    if len(a) == len(b) and sum(map(ne, a, b)) <= most:
        return True
    # What both begin or end with costs nothing.
    start, shorter = 0, min(len(a), len(b))
    while start < shorter and a[start] == b[start]:
        start += 1
    end = 0
    while end < shorter - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    return distance(a, b, most) <= most


def word_marks(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each line `MARKS` words of 64 bits, in which each of its words sets one bit."""
    bits = np.zeros((len(sizes), 64 * MARKS), bool)
    line = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    bits.ravel()[line * np.uint64(64 * MARKS) + hashes % np.uint64(64 * MARKS)] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def within(words: np.ndarray, first: np.ndarray, counts: np.ndarray, at: np.ndarray, to: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which of the pairs of lines (at, to) have an edit distance of at most `most`, which their lengths must allow.

    Hyyro's bit-parallel recurrence in a band along the diagonal, for many pairs side by side. So many edits leave a band
    of most + 1 cells, as each step off the way between the ends has to be taken back.
    """
    out = np.zeros(len(at), bool)
    at, to = np.where(counts[at] <= counts[to], at, to), np.where(counts[at] <= counts[to], to, at)
    everything = np.argsort(-counts[at], kind="stable")
    one, full = np.uint64(1), ~np.uint64(0)

    def above(bit: np.ndarray, lanes: int) -> np.ndarray:
        """A row of 64 bits for each lane, all bits from the given one on."""
        return full << np.clip(bit - 64 * np.arange(lanes)[:, None], 0, 64).astype(np.uint64)

    for some in np.split(everything, range(SIDE_BY_SIDE, len(everything), SIDE_BY_SIDE)) if len(at) else ():
        n, gap = counts[at[some]], counts[to[some]] - counts[at[some]]
        below, width, longest = (most[some] - gap) // 2, int(most[some].max()) + 1, int(n[0])
        lanes = -(-width // 64)
        here = words[np.minimum(first[at[some]][:, None] + np.arange(longest), len(words) - 1)]
        there = words[np.clip((first[to[some]] - below)[:, None] + np.arange(longest + width), 0, len(words) - 1)]
        # Bit o of row i is about word i + o - below of the longer line: whether the distance up to it goes up or down.
        up, down = above(below, lanes), np.zeros((lanes, len(some)), np.uint64)
        goal, lane, far = ((gap + below) % 64).astype(np.uint64), (gap + below) // 64, gap.copy()
        match = np.zeros((len(some), 8 * lanes), np.uint8)
        # Lines come in order of length, so those that go on are in front.
        live = np.searchsorted(-n, -np.arange(longest + 1), side="left").tolist()
        before, place = int(below.max()), np.arange(len(some))
        for i in range(longest):
            k = live[i]
            if i % 16 == 15:
                # Distances along a diagonal never fall, so pairs that are too far apart by now stay so.
                kept = np.flatnonzero(far <= most[some])
                if len(kept) < 3 * len(some) // 4:
                    some, n, below, goal, lane, far = some[kept], n[kept], below[kept], goal[kept], lane[kept], far[kept]
                    here, there, match = here[kept], there[kept], match[kept]
                    up, down = (x[:, kept[:np.searchsorted(kept, x.shape[1])]] for x in (up, down))
                    live = np.searchsorted(-n, -np.arange(longest + 1), side="left").tolist()
                    k = live[i]
            if not k:
                break
            up, down = up[:, :k], down[:, :k]
            match[:k, :(width + 7) // 8] = np.packbits(there[:k, i:i + width] == here[:k, i, None], axis=1, bitorder="little")
            same = match[:k].view("<u8").T
            if i < before:
                same = same & above(below[:k] - i, lanes)
            held = same & up
            total = held + up
            for x in range(1, lanes):
                over = total[x - 1] < held[x - 1]
                if x > 1:
                    total[x - 1] += carried
                    over |= carried & (total[x - 1] == 0)
                carried = over
            if lanes > 1:
                total[-1] += carried
            diagonal = (total ^ up) | same | down
            far[:k] += ((diagonal[lane[:k], place[:k]] if lanes > 1 else diagonal[0]) >> goal[:k] & one) == 0
            rise, fall = down | ~(diagonal | up), diagonal & up
            lower = diagonal >> one
            lower[:-1] |= diagonal[1:] << np.uint64(63)
            up, down = fall | ~(lower | rise), lower & rise
        out[some] = far <= most[some]
    return out


def all_words(lines: pa.Array, parted: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all lines, and the number of words of each."""
    told = [parted(lines[a:b]) for a, b in blocks(lines, TOGETHER)]
    words, counts = zip(*told, strict=True) if told else ((), ())
    return np.concatenate([np.zeros(0, np.uint64), *words]), np.concatenate([np.zeros(0, np.int64), *counts])


def verified(lines: pa.Array, fps: np.ndarray, ends: list[int], radius: int, similarity: float) -> list[tuple[int, int]]:
    """The links of `spanning_links` between lines in normal form."""
    return spanning_links(*all_words(lines, word_hashes), fps, ends, radius, similarity)


def spanning_links(words: np.ndarray, counts: np.ndarray, fps: np.ndarray, ends: list[int], radius: int,
                   similarity: float, members: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links of a forest that connects what pairs connect that are within the radius and similar, of members of one set.

    Lines are given by hashes of their words and the number of words of each, sets by the numbers of their lines in
    ascending order (unless given, each line is in one set) and where each set ends. What one set connects is not looked at in others.
    """
    members = np.arange(len(counts)) if members is None else members
    marks, first = word_marks(words, counts), np.cumsum(counts) - counts

    def may(at: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Which of the pairs are within the radius and not ruled out by their words: no edit removes two different ones."""
        some = np.flatnonzero(np.bitwise_count(fps[at] ^ fps[to]) <= radius)
        at, to = at[some], to[some]
        most = (1 - similarity) * np.maximum(counts[at], counts[to]) + 1e-9
        kept = np.abs(counts[at] - counts[to]) <= most
        for x, y in ((at, to), (to, at)):
            kept &= np.bitwise_count(marks[x] & ~marks[y]).sum(axis=1) <= most
        return some[kept]

    def alike(at: np.ndarray, to: np.ndarray) -> np.ndarray:
        longest = np.maximum(counts[at], counts[to])
        most = ((1 - similarity) * longest + 1e-9).astype(np.int64)
        out = np.zeros(len(at), bool)
        # Replacing word by word is one way of editing.
        even = np.flatnonzero((counts[at] == counts[to]) & (longest > 0))
        for part in np.array_split(even, len(even) // SIDE_BY_SIDE + 1):
            size = counts[at[part]]
            begin = np.cumsum(size) - size
            place = np.arange(size.sum()) - np.repeat(begin, size)
            unlike = words[np.repeat(first[at[part]], size) + place] != words[np.repeat(first[to[part]], size) + place]
            if len(part):
                out[part] = np.add.reduceat(unlike, begin, dtype=np.int64) <= most[part]
        short = np.flatnonzero(~out & (longest <= SHORT_LINE))
        out[short] = within(words, first, counts, at[short], to[short], most[short])
        for k in np.flatnonzero(~out & (longest > SHORT_LINE)).tolist():
            a, b = (words[first[i]:first[i] + counts[i]].tolist() for i in (to[k], at[k]))
            out[k] = similar(a, b, similarity)
        return out

    root, links = np.arange(len(counts)), []

    def link(at: np.ndarray, to: np.ndarray) -> None:
        """Look at pairs whose lines are not connected yet, few for each line first, as these connect most others."""
        share = 1
        while len(at):
            apart = root[at] != root[to]
            at, to = at[apart], to[apart]
            order = np.argsort(root[at], kind="stable")
            at, to = at[order], to[order]
            group = root[at]
            place = np.arange(len(at)) - np.searchsorted(group, group)
            now = place < share
            good = alike(at[now], to[now])
            for i, j in zip(at[now][good].tolist(), to[now][good].tolist(), strict=True):
                x, y = i, j
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                if x != y:
                    links.append((i, j))
                    root[max(x, y)] = min(x, y)
            while len(deeper := np.flatnonzero(root[root] != root)):
                root[deeper] = root[root[deeper]]
            at, to, share = at[~now], to[~now], 2 * share

    # Each line is paired with those before it in its set, some lines at a time.
    stops = np.array(ends, np.int64)
    sizes = np.diff(stops, prepend=0)
    start = np.repeat(stops - sizes, sizes)
    before = np.arange(len(start)) - start
    pairs, i = np.cumsum(before), 0
    while i < len(start):
        stop = max(i + 1, int(np.searchsorted(pairs, pairs[i] - before[i] + PAIRS_AT_ONCE, side="right")))
        at = np.repeat(np.arange(i, stop), before[i:stop])
        to = np.arange(len(at)) + np.repeat(start[i:stop] - (pairs[i:stop] - before[i:stop] - (pairs[i] - before[i])), before[i:stop])
        at, to = members[at], members[to]
        apart = root[at] != root[to]
        at, to = at[apart], to[apart]
        kept = may(at, to)
        # A pair may be in several sets.
        at, to = np.divmod(np.unique(at[kept] * len(counts) + to[kept]), len(counts))
        link(at, to)
        i = stop
    return links


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive rows that agree in the first `keys` columns."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(len(batch) - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if now is not None and key != now:
                yield held
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def bucket_places(fps: np.ndarray, keys: np.ndarray, words: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """A row for each line: its places, of each choice of blocks and then of each key.

    A place is the bucket in its upper bits and the number of words in its lower `_WORDS` bits.
    """
    places = np.concatenate([fps[:, None] & masks, keys.astype(np.uint64)], axis=1)
    places = (places ^ _MASK[:places.shape[1]]) * _ODD[5]
    places = (places ^ (places >> np.uint64(32))) * _ODD[6]
    return places >> np.uint64(_WORDS) << np.uint64(_WORDS) | np.minimum(words, _MOST_WORDS).astype(np.uint64)[:, None]


def bucket_sets(nodes: DataFrame, masks: list[int], count: int, radius: int, similarity: float) -> DataFrame:
    """(set, fp): fingerprints that hang together in a bucket of blocks or of keys; equal sets have one name.

    Buckets are dealt to ranges of about `SET_ROWS` places, first those of blocks and then those of keys. A task packs what
    it has for a range in one row, so that Spark moves few rows, and all of a range meets in one task.
    """
    each = [max(1, -(-count * kinds // SET_ROWS)) for kinds in (len(masks), BANDS)]
    choices, ranges = np.array(masks, np.uint64), np.repeat(np.array(each, np.uint64), (len(masks), BANDS))
    offset = np.repeat(np.array([0, each[0]], np.uint64), (len(masks), BANDS))

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        fps, words = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (0, 2))
        keys = np.concatenate([bytes_of(b.column(1))[0].view(np.uint32) for b in held])
        fps = fps.view(np.uint64)
        places = bucket_places(fps, keys.reshape(-1, BANDS), words, choices)
        part = (offset + ((places >> np.uint64(40)) * ranges >> np.uint64(24))).ravel()
        # Numbers of 16 bits are sorted by their digits.
        order = np.argsort(part.astype(np.uint16) if sum(each) <= 1 << 16 else part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        ends = pa.array(np.append(first, len(part)) * 8, pa.int64())
        columns = [pa.Array.from_buffers(pa.large_binary(), len(first), [None, ends.buffers()[1], pa.py_buffer(
            np.ascontiguousarray(x))]).cast(pa.binary()) for x in (places.ravel()[order], fps[order // places.shape[1]])]
        return pa.RecordBatch.from_arrays([pa.array(part[first].astype(np.int64)), *columns], ["part", "places", "fps"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= PACKED_LINES:
                yield packed(held)
                held = []
        if sum(map(len, held)):
            yield packed(held)

    def sets(part: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        at, fp = (np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for b in held for x in b.column(i)]) for i in (1, 2))
        order = np.argsort(at)
        at, fp = at[order].view(np.int64), fp[order]
        # Most rows are alone in their bucket.
        same = (at[1:] >> _WORDS) == (at[:-1] >> _WORDS)
        several = np.flatnonzero(np.append(same, False) | np.append(False, same))
        at, fp = at[several], fp[several]
        bits = radius if part < each[0] else max(radius, WIDE)
        root = sets_of_buckets(at >> _WORDS, fp, at & _MOST_WORDS, bits, similarity)
        kept = np.flatnonzero(root >= 0)
        # The name of a set is a sum over its members.
        own = (fp ^ (fp >> np.uint64(31))) * _ODD[1]
        names = np.zeros(len(root), np.uint64)
        np.add.at(names, root[kept], own[kept] ^ (own[kept] >> np.uint64(29)))
        return pa.RecordBatch.from_arrays(
            [pa.array(names[root[kept]].view(np.int64)), pa.array(fp[kept].view(np.int64))], ["set", "fp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _runs(batches, 1):
            yield sets(held[0].column(0)[0].as_py(), held)

    dealt = nodes.select("fp", "keys", "words").mapInArrow(pack, "part bigint, places binary, fps binary").repartition("part")
    return dealt.sortWithinPartitions("part").mapInArrow(run, "set bigint, fp bigint")


def candidate_sets(nodes: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """(set, ...): lines that hang together in a bucket of blocks or of keys, of nodes (h, fp, keys, words, ...).

    Buckets hold fingerprints alone; a set has all lines of its fingerprints, with all columns but keys and words.
    """
    count = nodes.count()
    met = bucket_sets(nodes, block_masks(count, radius), count, radius, similarity).distinct()
    return staged(met.join(nodes.drop("keys", "words"), "fp"), "sets")


def sets_with_company(sets: DataFrame) -> DataFrame:
    """(set, parts, least, slot): of each set the number of its parts, its least line, and which of the sets with it go along.

    A line is in no more sets than it has buckets. Those that have the same least line and more than `SET_LINES` lines in all are dealt to slots.
    """
    sizes = sets.groupBy("set").agg(F.count("*").alias("n"), F.min("h").alias("least"))
    slots = F.ceil(F.sum("n").over(Window.partitionBy("least")) / SET_LINES)
    return sizes.select("set", F.ceil(F.col("n") / SET_LINES).cast("int").alias("parts"), "least",
                        F.pmod("set", slots).cast("int").alias("slot"))


def verified_links(lines: DataFrame, radius: int = WIDE, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between the lines of each set within the radius whose edit similarity reaches the threshold.

    lines are (least, slot, set, parts, h, fp, line): a row for each line of each set, with the least line of the set, its slot
    and the number of its parts. Sets with the same least line share most of their lines, so a task has a slot of them together.
    """
    part = F.pmod(F.col("h"), F.col("parts")).cast("int")
    rows = lines.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "least", "slot", F.least(part, "j").alias("x"), F.greatest(part, "j").alias("y"), "set", "h", "fp", "line")

    def links(batch: pa.RecordBatch, ends: list[int]) -> pa.RecordBatch:
        h, one, members = np.unique(batch.column(5).to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
        fps = batch.column(6).to_numpy(zero_copy_only=False)[one].view(np.uint64)
        words = all_words(batch.column(7).take(pa.array(one)).cast(pa.string()), normal_words)
        pairs = np.array(spanning_links(*words, fps, ends, radius, similarity, members), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(h[pairs[:, 0]]), pa.array(h[pairs[:, 1]])], ["a", "b"])

    def whole(held: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, list[int]]:
        batch = pa.concat_batches(held)
        change = np.zeros(max(0, len(batch) - 1), bool)
        for i in range(5):
            key = batch.column(i).to_numpy(zero_copy_only=False)
            change |= key[1:] != key[:-1]
        return batch, (np.flatnonzero(change) + 1).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        wanted = LINES_AT_ONCE
        for batch in batches:
            held.append(batch)
            if (size := sum(map(len, held))) >= wanted or sum(b.nbytes for b in held) >= TEXT_AT_ONCE * wanted / LINES_AT_ONCE:
                # The last set may go on in the next batch.
                batch, ends = whole(held)
                if ends:
                    yield links(batch.slice(0, ends[-1]), ends)
                held, wanted = [batch.slice(ends[-1])] if ends else [batch], LINES_AT_ONCE if ends else 2 * size
        if sum(map(len, held)):
            batch, ends = whole(held)
            yield links(batch, [*ends, len(batch)])

    return rows.repartition("least", "slot", "x", "y").sortWithinPartitions("least", "slot", "x", "y", "set", "h").mapInArrow(
        run, "a bigint, b bigint")


def removable(docs: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(_key, _gone): the numbers of the lines that go, of each document (_key, _id, _text) that loses some."""
    send_package(docs)

    @F.arrow_udf("array<struct<no: int, start: int, size: int, h: bigint, fp: bigint, keys: binary, words: int>>")
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield from signatures(column)

    with_keys = staged(docs.select("_key", "_id", F.explode(signed("_text")).alias("s")).select("_key", "_id", "s.*"), "lines")
    place = F.struct("_id", "_key", "no", "start", "size")
    keyed = staged(with_keys.groupBy("h").agg(F.first("fp").alias("fp"), F.min(place).alias("at"),
                                              F.count("*").alias("n"), F.first("keys").alias("keys"),
                                              F.first("words").alias("words")), "nodes")
    # Keys are most of these tables; they go as soon as they have been used.
    occurrences = staged(with_keys.select("_key", "_id", "no", "h"), "lines")
    drop_staged(with_keys)
    sets = candidate_sets(keyed.select("h", "fp", "keys", "words", "at._key", "at.start", "at.size"), radius, similarity)
    nodes = staged(keyed.select("h", "at", "n"), "nodes")
    drop_staged(keyed)
    sizes = sets_with_company(sets)
    by_document = sets.join(sizes, "set").groupBy("_key").agg(F.collect_list(F.struct("least", "slot", "set", "parts", "h", "fp", "start", "size")).alias("wanted"))
    # Rows that agree in id and text hand their lines out once.
    once = docs.groupBy("_key").agg(F.first(F.col("_text").cast("binary")).alias("_bytes"))
    lines = once.join(by_document.hint("shuffle_hash"), "_key").select("_bytes", F.explode("wanted").alias("w")).select(
        "w.least", "w.slot", "w.set", "w.parts", "w.h", "w.fp", F.substring("_bytes", F.col("w.start") + 1, F.col("w.size")).alias("line"))
    found = components(verified_links(lines, max(radius, WIDE), similarity))
    grouped = nodes.join(found, nodes.h == found.node, "left").select(
        "h", "at", "n", F.coalesce("component", "h").alias("group"), F.col("component").isNotNull().alias("linked"))
    repeated = grouped.where("n > 1 or linked")
    keeper = repeated.groupBy("group").agg(F.min("at").alias("keep"))
    going = repeated.join(keeper, "group").select("h", F.col("keep._key").alias("keep_key"), F.col("keep.no").alias("keep_no"))
    gone = occurrences.join(going, "h").where("_key != keep_key or no != keep_no")
    gone = staged(gone.groupBy("_key").agg(F.collect_set("no").alias("_gone")), "gone-lines")
    for done in (occurrences, nodes, sets, found):
        drop_staged(done)
    return gone


def dedup_lines(docs: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Replace the text of every row by its lines that stay; add n_lines and n_removed."""
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("_row"), row_key(id_col, text_col).alias("_key"))
    gone = removable(docs.where(F.col(text_col).isNotNull()).select(
        row_key(id_col, text_col).alias("_key"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), radius, similarity)
    # Hashing the short rows of line numbers spares a sort of the texts; a row's text is shuffled once.
    split = rows.join(gone.hint("shuffle_hash"), "_key", "left").withColumn(
        "_text", F.col("_row").getField(text_col)).withColumn("_lines", F.split("_text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    left = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
    met = split.select("_row.*", left.alias("_tl_text"), F.coalesce(
        F.size("_lines"), F.lit(0)).alias("_tl_lines"), F.coalesce(F.size("_gone"), F.lit(0)).alias("_tl_gone"))
    order = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    return with_columns(met, {"n_lines": F.col("_tl_lines"), "n_removed": F.col("_tl_gone")}).select(
        *(F.col("_tl_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in order), "n_lines", "n_removed")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))
