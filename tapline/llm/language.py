"""Language identification by rank-order profiles.

The profile of a language is its `PROFILE` most frequent n-grams (one to `LONGEST` letters, words padded with a blank),
counted over all texts that teach. A document is described in the same way, and goes to the language whose ranks lie
closest: the out-of-place distance adds up, over the document's n-grams, how far their ranks are apart, and `PROFILE` for
an n-gram that the profile lacks.

Counting runs inside tasks and is merged there and in a shuffle by language and n-gram; only the profiles, a fixed number
of rows for each language, reach the driver. Documents are not shuffled.

Texts that are null, empty or without a letter are `und` with score 0, and so is every text when nothing was learned.
Rows without a language teach nothing. Ties in counts are settled by code point, ties in distance by language name.
Repeated rows count and are predicted like any other; an input column with the name of a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapline.llm.common import blocks, crc_of_id, send_package, strings_of, table, with_columns

PROFILE, LONGEST = 400, 3
UNKNOWN = "und"
# Where an n-gram has no further letter: above every code point. Codes have 21 bits for each of three letters.
NONE = 0x1FFFFF
# Distinct n-grams of a language that a task holds before it merges them.
_MERGE = 1 << 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, n-gram and count of all distinct n-grams of each text, in order of text and n-gram."""
    lowered = [text.lower() for text in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    codes = np.frombuffer("\0".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(_letters()[codes], codes, 0)
    # Each text begins with the blank before it.
    owner = np.append(np.repeat(np.arange(len(texts)), sizes + 1), len(texts))
    present = np.zeros(0x110000, bool)
    present[codes] = True
    present[0] = False
    alphabet = np.concatenate(([0], np.flatnonzero(present), [NONE])).astype(np.int64)
    place = np.zeros(0x110000, np.int32)
    place[alphabet[:-1]] = np.arange(len(alphabet) - 1)
    signs, base = place[codes].astype(np.int64), len(alphabet)
    letter, none = signs > 0, base - 1
    a, b, c = signs[:-2], signs[1:-1], signs[2:]
    la, lb, lc = letter[:-2], letter[1:-1], letter[2:]
    cube = base ** 3
    key = owner[:-2] * cube + (a * base + b) * base
    # Three: the middle is a letter. Two: not both blank. One: a letter.
    found = [(key + c)[lb], (key + none)[la | lb], (key + (none - b) * base + none)[la]]
    tail = len(signs) - 2
    if tail >= 0 and (letter[tail] or letter[tail + 1]):
        found.append(np.array([owner[tail] * cube + (signs[tail] * base + signs[tail + 1]) * base + none]))
        found.append(np.array([owner[i] * cube + (signs[i] * base + none) * base + none
                               for i in (tail, tail + 1) if letter[i]], np.int64))
    keys, counts = _counted(np.concatenate(found))
    text, gram = np.divmod(keys, cube)
    first, rest = np.divmod(gram, base * base)
    second, third = np.divmod(rest, base)
    return text, alphabet[first] << 42 | alphabet[second] << 21 | alphabet[third], counts


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often (or with what weight) each occurs."""
    if weights is None:
        keys = np.sort(keys)
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
        return keys[starts], np.diff(np.append(starts, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[starts], np.add.reduceat(weights[order], starts) if len(starts) else weights[:0]


def ranked(texts: list[str], size: int = PROFILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, rank and n-gram of the `size` most frequent n-grams of each text; ties in order of the n-gram."""
    text, gram, count = grams(texts)
    if not len(text):
        return text, text, gram
    most = int(count.max())
    order = np.argsort(text * (most + 1) + (most - count), kind="stable")
    starts = np.searchsorted(text, np.arange(len(texts)))
    rank = np.arange(len(text)) - starts[text]
    kept = rank < size
    return text[kept], rank[kept], gram[order][kept]


@dataclass(frozen=True)
class Profiles:
    """Languages in order of name, all n-grams of their profiles in order, and the rank of each in each profile."""

    languages: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of the languages of all rows that have a text and a language."""
    send_package(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            return _counted(*(np.concatenate(part) for part in zip(*held[lang], strict=True)))

        for batch in batches:
            texts, langs = batch.column(0), batch.column(1).to_pylist()
            for start, stop in blocks(texts):
                owner, gram, n = grams(strings_of(texts[start:stop]))
                names, of = np.unique(np.array(langs[start:stop], object).astype(str), return_inverse=True)
                for i, lang in enumerate(names.tolist()):
                    mine = of[owner] == i
                    held.setdefault(lang, []).append(_counted(gram[mine], n[mine]))
                    if sum(len(part[0]) for part in held[lang]) > _MERGE:
                        held[lang] = [merged(lang)]
        for lang in held:
            gram, n = merged(lang)
            for i in range(0, len(gram), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram[part]), pa.string()), pa.array(gram[part]), pa.array(n[part])],
                    ["lang", "gram", "n"])

    teaching = docs.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where("t is not null and l is not null")
    counts = teaching.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < PROFILE)
    rows = top.select("lang", "gram", "rank").collect()
    languages, known = sorted({r.lang for r in rows}), np.unique(np.array([r.gram for r in rows], np.int64))
    ranks = np.full((len(languages), len(known) + 1), PROFILE, np.int64)
    for r in rows:
        ranks[languages.index(r.lang), np.searchsorted(known, r.gram)] = r.rank
    return Profiles(tuple(languages), known, ranks)


def distances(texts: list[str], profiles: Profiles) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each text to each language, as a share of the largest possible; and its n-grams."""
    text, rank, gram = ranked(texts)
    size = np.bincount(text, minlength=len(texts))
    at = np.minimum(np.searchsorted(profiles.grams, gram), max(0, len(profiles.grams) - 1))
    known = profiles.grams[at] == gram if len(profiles.grams) else np.zeros(len(gram), bool)
    at = np.where(known, at, len(profiles.grams))
    out = np.zeros((len(texts), len(profiles.languages)))
    for i in range(len(profiles.languages)):
        place = profiles.ranks[i][at]
        away = np.where(place < PROFILE, np.abs(place - rank), PROFILE)
        out[:, i] = np.bincount(text, away, len(texts)) / np.maximum(1, size * PROFILE)
    return out, size


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """Add the nearest language of each whole text, and how much nearer it is than the next (0.5 to 1)."""
    send_package(docs)

    @F.arrow_udf("struct<lang string, score double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array([*profiles.languages, UNKNOWN], object)
        for column in batches:
            langs, scores = [], []
            for start, stop in blocks(column):
                if not profiles.languages:
                    langs += [UNKNOWN] * (stop - start)
                    scores.append(np.zeros(stop - start))
                    continue
                far, size = distances(strings_of(column[start:stop]), profiles)
                best = far.argmin(axis=1)
                near = far[np.arange(len(far)), best]
                other = np.partition(far, 1, axis=1)[:, 1] if far.shape[1] > 1 else np.ones(len(far))
                score = np.where(near + other > 0, other / np.maximum(near + other, 1e-12), 0.5)
                langs += names[np.where(size > 0, best, len(names) - 1)].tolist()
                scores.append(np.where(size > 0, score, 0.0))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                names=["lang", "score"])

    found = docs.withColumn("_tl_found", run(F.col(text_col)))
    return with_columns(found, {lang_col: F.col("_tl_found.lang"), score_col: F.col("_tl_found.score")}).drop("_tl_found")


def predicted(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; the rows whose id's checksum leaves 2 by 4 teach nothing."""
    held_out = F.coalesce(crc_of_id("doc_id") % 4 == 2, F.lit(False))
    profiles = learn(docs.where(~held_out))
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), profiles).select(
        "doc_id", "held_out", "lang_pred", "score")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(table(spark, sf_dir, "documents"))
