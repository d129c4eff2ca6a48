"""Operators that compare documents, against plain versions on whole small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapline.llm import decontaminate, line_dedup, passages, sharding, simhash
from tapline.llm.components import components
from tests.conftest import SF_DIR

DIR = str(SF_DIR)


def grouped(n, links):
    root = list(range(n))

    def of(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = of(a), of(b)
        root[max(x, y)] = min(x, y)
    return [of(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(40, 90)] + [(100, i) for i in range(101, 140)]
    links += [tuple(map(int, rng.integers(0, 40, 2))) for _ in range(25)] + [(200, 200)]
    wanted = grouped(201, links)
    frame = spark.createDataFrame(links + [(None, 3)], "x long, y long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {i: wanted[i] for i in {i for x in links if x[0] != x[1] for i in x}}
    assert components(frame.limit(0)).count() == 0


def plain_fingerprint(text, words=4):
    import xxhash

    text = text.translate({i: i + 32 for i in range(65, 91)})
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    bits = Counter(b for run in runs for b in range(64) if xxhash.xxh64_intdigest(run, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(runs))


def check_simhash(rows, texts):
    fps = [plain_fingerprint(t or "") for _, t in texts]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    group = grouped(len(fps), links)
    least = {}
    for (doc, _), g in zip(texts, group, strict=True):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    wanted = sorted((str(doc), f"{fp:016x}", str(least.get(g))) for (doc, _), fp, g in zip(texts, fps, group, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == wanted
    return links


def test_simhash_query(spark, documents):
    rows = simhash.op6_simhash(spark, DIR).collect()
    assert check_simhash(rows, [tuple(r) for r in documents.select("doc_id", "text").collect()])


def test_simhash_odd_rows(odd):
    rows = simhash.near_duplicates(odd).withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
    assert rows.columns[0] == "doc_id" and len(rows.columns) == len(odd.columns) + 1
    check_simhash(rows.collect(), [tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    first = simhash.first_of_each(odd)
    assert first.columns == odd.columns
    assert sorted(str(r.doc_id) for r in first.collect()) == ["0", "3", "4", "5", "6", "7", "8", "None"]


def test_unlike_texts_with_one_id_are_not_duplicates(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, "a text of its own with some words"), (1, "quite another one that shares nothing at all"), (2, "the third, unlike both"),
            (3, words), (3, words + " more"), (4, words), (3, words)]
    first = simhash.first_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(r.doc_id for r in first) == [1, 1, 2, 3]


@pytest.mark.parametrize("lead", [2, 5, 9])
def test_buckets_find_all_links(spark, lead, monkeypatch):
    rng = np.random.default_rng(lead)
    base = rng.integers(0, 1 << 63, 30, np.int64)
    flips = [int(b) ^ sum(1 << int(i) for i in rng.choice(63, rng.integers(0, 6), replace=False)) for b in base for _ in range(6)]
    fps = sorted(set(flips))
    monkeypatch.setattr(simhash, "bucket_bits", lambda count: lead)
    monkeypatch.setattr(simhash, "AT_ONCE", 5000)
    links = simhash.links_within(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    true = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    at = {f: i for i, f in enumerate(fps)}
    assert grouped(len(fps), true) == grouped(len(fps), [(at[a], at[b]) for a, b in links])


def test_shards(spark, documents, odd):
    rows = sharding.op1_kd_shards(spark, DIR).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by = defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 16, zlib.crc32(texts[r.doc_id].encode()))
        by[r.shard].append(r)
    assert sorted(by) == list(range(40))
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by.values())
    loads = [sum(r.size for r in part) for part in by.values()]
    assert max(loads) - min(loads) <= 2 * max(r.size for r in rows)


def test_shards_split_hot_values_and_odd_rows(spark, odd):
    hot = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("one").alias("source"))
    placed = sharding.kd_shards(hot, [sharding.category("source")], target_bytes=25 * 400)
    loads = [r[1] for r in placed.groupBy("shard").count().collect()]
    assert len(loads) == 10 and max(loads) - min(loads) <= 20
    out = sharding.kd_shards(odd, [sharding.magnitude("n_chars"), sharding.category("lang")], shards=3)
    assert out.count() == odd.count()
    assert sharding.kd_shards(odd.limit(0), [sharding.category("lang")], target_bytes=10).count() == 0


def test_shards_keep_equal_texts_together(spark):
    rows = [(i, f"text {i % 1500} " + "word " * (i % 1500 % 7), f"source {i % 11}") for i in range(4000)]
    rows += [(4000 + i, "a text that very many rows share", f"source {i % 11}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text"))
    placed = sharding.kd_shards(docs, [sharding.magnitude("n_chars"), sharding.category("source")], shards=12)
    shard = {r.doc_id: r.shard for r in placed.collect()}
    groups, loads = defaultdict(set), defaultdict(int)
    for i, text, _ in rows:
        groups[text].add(shard[i])
        loads[shard[i]] += len(text) + 16
    assert len(shard) == 6000 and all(len(s) == 1 for text, s in groups.items() if text != rows[-1][1])
    assert max(loads.values()) <= 1.1 * sum(loads.values()) / 12 and len(loads) == 12


def test_write_shards(odd, tmp_path):
    placed = sharding.kd_shards(odd.where("doc_id < 7"), [sharding.category("lang")], shards=2)
    sharding.write_shards(odd.where("doc_id < 7").drop("shard"), placed, str(tmp_path / "out"))
    assert odd.sparkSession.read.parquet(str(tmp_path / "out")).count() == 7


def similar_pairs(norms):
    """All pairs of lines with an edit similarity of 0.8 or more, whatever their fingerprints."""
    numbers = {}
    bits = [sum(1 << numbers.setdefault(w, len(numbers)) for w in set(norm.split())) for norm in norms]
    words = [norm.split() for norm in norms]

    def may(i, j):
        # No edit removes two different words.
        return (bits[i] & ~bits[j]).bit_count() <= (most := 0.2 * max(len(words[i]), len(words[j]))) and (
            bits[j] & ~bits[i]).bit_count() <= most

    return [(i, j) for i in range(len(norms)) for j in range(i) if may(i, j) and line_dedup.similar(words[i], words[j], 0.8)]


def plain_lines(docs):
    """Texts by (id, text) after removal, of rows (id, text)."""
    occurrences = defaultdict(set)
    for doc, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            norm = re.sub("[0-9]", "0", re.sub(r"[\W_]+", " ", line.lower())).strip(" ")
            if norm:
                occurrences[norm].add((doc is not None, doc or 0, text, n))
    norms = list(occurrences)
    links = similar_pairs(norms)
    best = {}
    group = grouped(len(norms), links)
    for i, norm in enumerate(norms):
        best[group[i]] = min(best.get(group[i], min(occurrences[norm])), min(occurrences[norm]))
    gone = {(o[1:], ) for i, norm in enumerate(norms) for o in occurrences[norm] if o != best[group[i]]}
    return {(doc, text): None if text is None else "\n".join(
        x for n, x in enumerate(text.split("\n")) if ((doc or 0, text, n),) not in gone) for doc, text in docs}, links


def test_line_dedup(spark, documents, odd):
    extra = spark.createDataFrame(
        [(9000 + i, "the quick brown fox jumps over the lazy dog near the river bank today " + w) for i, w in
         enumerate(["now", "now!", "then", "NOW 12", "now 99"])], "doc_id long, text string")
    for docs in (documents.select("doc_id", "text").union(extra), odd.where("doc_id is not null")):
        wanted, links = plain_lines([tuple(r) for r in docs.select("doc_id", "text").collect()])
        done = line_dedup.dedup_lines(docs.withColumn("_tl_was", F.col("text")))
        for r in done.collect():
            assert r.text == wanted[r.doc_id, r._tl_was]
    assert line_dedup.dedup_lines(odd).count() == odd.count()
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


@pytest.mark.parametrize("words, edits, least", [(10, 1, 0.99), (20, 1, 0.99), (20, 2, 0.99), (50, 5, 0.99), (5, 1, 0.9),
                                                 (10, 2, 0.9), (20, 4, 0.9)])
def test_lines_with_edits_are_found(spark, words, edits, least):
    rng = np.random.default_rng(words + edits)
    rows = []
    for i in range(500):
        line = rng.integers(0, 26 ** 4, words)
        other = line.copy()
        other[rng.choice(words, edits, replace=False)] = rng.integers(0, 26 ** 4, edits)
        rows += [(2 * i + k, " ".join("".join(chr(97 + w // 26 ** p % 26) for p in range(4)) for w in each.tolist()))
                 for k, each in enumerate((line, other))]
    done = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(done[2 * i] for i in range(500))
    assert sum(done[2 * i + 1] for i in range(500)) >= least * 500


def test_sets_of_buckets():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n, radius = int(rng.integers(0, 30)), int(rng.integers(0, 12))
        bucket = np.sort(rng.integers(0, 4, n))
        fps = rng.integers(0, 1 << 64, 3, np.uint64)[rng.integers(0, 3, n)]
        for _ in range(rng.integers(0, 10)):
            fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
        links = [(i, j) for i in range(n) for j in range(i)
                 if bucket[i] == bucket[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius]
        wanted, found = defaultdict(list), defaultdict(list)
        for i, (a, b) in enumerate(zip(grouped(n, links), line_dedup.sets_of_buckets(bucket, fps, np.full(n, 9), radius, 0.8), strict=True)):
            wanted[a].append(i)
            if b >= 0:
                found[b].append(i)
        assert sorted(found.values()) == sorted(x for x in wanted.values() if len(x) > 1)


def test_line_query(spark, documents):
    wanted, _ = plain_lines([tuple(r) for r in documents.select("doc_id", "text").collect()])
    texts = {doc: text for (doc, _), text in wanted.items()}
    for r in line_dedup.op8_line_dedup(spark, DIR).collect():
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edit_distance_and_bits():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = (rng.choice(list("abcd"), rng.integers(0, 12)).tolist() for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        assert line_dedup.distance(a, b, 99) == row[-1]
        assert line_dedup.similar(a, b, 0.5) == (row[-1] <= int(0.5 * max(len(a), len(b)) + 1e-9))
    from tapline.llm.common import majority_bits

    hashes = rng.integers(0, 1 << 64, 1700, np.uint64)
    sizes = np.array([0, 1, 2, 700, 0, 255, 256, 486])
    got, at = majority_bits(hashes, sizes), 0
    for size, bits in zip(sizes, got, strict=True):
        part = hashes[at:at + size].tolist()
        at += size
        assert int(bits) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > size)


def test_passages_find_all_exact_repeats(spark, texts):
    rows = passages.op5_passages(spark, DIR).collect()
    words = {i: re.sub(r"[\W_]+", " ", t.lower()).split() for i, t in texts.items()}
    holders = defaultdict(set)
    for i, w in words.items():
        for p in range(len(w) - passages.PASSAGE + 1):
            holders[tuple(w[p:p + passages.PASSAGE])].add(i)
    wanted = {i for held in holders.values() if len(held) > 1 for i in held}
    assert wanted <= {r.doc_id for r in rows} | {r.other_id for r in rows}
    for r in rows:
        a, b = words[r.doc_id][r.start:r.stop], words[r.other_id][r.other_start:r.other_stop]
        assert r.score < 1 or a == b
        assert len(set(a) & set(b)) >= 0.3 * min(len(set(a)), len(set(b)))
        assert r.passage_stop - r.passage_start >= passages.PASSAGE


def test_passages_with_edits_and_odd_rows(spark, odd):
    rng = np.random.default_rng(3)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 5000, n)]

    shared = words(80)
    edited = [w for i, w in enumerate(shared) if i % 25 != 24]
    edited[30] = "other"
    rows = [(1, " ".join(words(60) + shared + words(30))), (2, " ".join(words(10) + edited + words(70))), (3, " ".join(words(200)))]
    out = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_id) for r in out} == {(1, 2), (2, 1)}
    [mine] = [r for r in out if r.doc_id == 1]
    assert abs(mine.start - 60) <= 2 and abs(mine.stop - 140) <= 2 and mine.score > 0.8
    assert passages.repeated_passages(odd).count() == 0
    assert passages.repeated_passages(odd.limit(0)).count() == 0


def test_passages_with_an_indel_near_an_end(spark):
    rng = np.random.default_rng(11)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1_000_000, n)]

    rows, wanted = [], set()
    for size in (52, 55, 60):
        for at in (4, 8, 12, -12, -8, -4):
            for more in (["more"], []):
                shared, n = words(size), len(rows)
                edited = shared[:at] + more + shared[at + (not more):]
                rows += [(n, " ".join(words(60) + shared + words(70))), (n + 1, " ".join(words(30) + edited + words(40)))]
                wanted |= {(n, 60, 60 + size), (n + 1, 30, 30 + len(edited))}
    out = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.start, r.stop) for r in out} == wanted


def test_passages_of_phrases_that_other_texts_hold(spark):
    rng = np.random.default_rng(21)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1_000_000, n)]

    rows, wanted = [], set()
    # Texts that hold each phrase of a passage, and the words after which it is edited in the second text.
    for holders, every in ((12, 100), (2, 13)):
        shared, n = words(60), len(rows)
        edited = ["other" if i % every == every - 1 else w for i, w in enumerate(shared)]
        rows += [(n, " ".join(words(20) + shared + words(30))), (n + 1, " ".join(words(40) + edited + words(10)))]
        wanted |= {(n, n + 1, 20, 80), (n + 1, n, 40, 100)}
        for i in range(0, 54):
            rows += [(len(rows) + j, " ".join(words(15) + shared[i:i + 7] + words(15))) for j in range(holders)]
    out = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_id, r.start, r.stop) for r in out} == wanted


def test_passages_of_more_texts_than_few_are_one_class(spark):
    rng = np.random.default_rng(22)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1_000_000, n)]

    shared, twice, rows = words(60), words(55), []
    for i in range(12):
        rows.append((i, " ".join(words(i) + shared + words(30))))
    # One text holds a passage at two places, with as many other words between as keep them apart.
    rows += [(20, " ".join(twice + words(200) + twice)), (21, " ".join(words(9) + twice)), (22, rows[0][1])]
    out = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    classes = defaultdict(set)
    for r in out:
        classes[r.passage_class].add((r.doc_id, r.passage_start, r.passage_stop))
    assert sorted(classes.values(), key=len) == [
        {(22, 0, 90)}, {(20, 0, 55), (20, 255, 310), (21, 9, 64)}, {(i, i, i + 60) for i in range(12)}]


def test_passages_edited_in_phrases_that_many_texts_hold(spark):
    rng = np.random.default_rng(23)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1_000_000, n)]

    def edited(passage, every):
        return ["other" if i % every == every - 1 else w for i, w in enumerate(passage)]

    rows, wanted = [], {}
    # Two and twelve texts hold a passage with edits, and twelve others each phrase of it.
    for many, size, every in ((2, 60, 20), (12, 80, 23)):
        shared = words(size)
        for j in range(many):
            # Each has edits of its own, in the same places.
            mine = [f"x{len(rows)}" if w == "other" else w for w in edited(shared, every)]
            wanted[len(rows)] = (20 + j, 20 + j + size, many + size)
            rows.append((len(rows), " ".join(words(20 + j) + mine + words(30))))
        for i in range(size - 6):
            rows += [(len(rows) + j, " ".join(words(15) + shared[i:i + 7] + words(15))) for j in range(12)]
    out = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: r for r in out}
    assert set(found) == set(wanted)
    for doc, (start, stop, _) in wanted.items():
        # Words after the last edit may be fewer than a seed has.
        assert abs(found[doc].passage_start - start) <= 3 and abs(found[doc].passage_stop - stop) <= 20 and (
            found[doc].passage_stop - found[doc].passage_start >= passages.PASSAGE)
    classes = defaultdict(set)
    for r in out:
        classes[wanted[r.doc_id][2]].add(r.passage_class)
    assert [len(c) for c in classes.values()] == [1, 1]


def test_passages_edited_at_the_second_place_of_a_text(spark):
    rng = np.random.default_rng(24)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1_000_000, n)]

    rows, wanted = [], set()
    # Whichever of the two texts comes first in order of hashes.
    for n in range(0, 16, 2):
        shared = words(60)
        again = ["other" if i % 20 == 19 else w for i, w in enumerate(shared)][:59]
        rows += [(n, " ".join(words(10) + shared + words(100) + again + words(10))), (n + 1, " ".join(words(30) + shared + words(5)))]
        wanted |= {(n, 10, 70), (n, 170, 229), (n + 1, 30, 90)}
    out = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.passage_start, r.passage_stop) for r in out} == wanted


def test_passages_of_one_word_said_again_and_again(spark):
    rng = np.random.default_rng(25)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1_000_000, n)]

    rows = [(0, " ".join(words(20) + ["la"] * 25 + ["one"] + ["la"] * 25 + words(40))),
            (1, " ".join(words(35) + ["la"] * 25 + ["two"] + ["la"] * 25 + words(10))),
            (2, " ".join(words(50) + ["la"] * 13 + words(50)))]
    out = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.passage_start, r.passage_stop) for r in out} == {(0, 20, 71), (1, 35, 86)}
    assert len({r.passage_class for r in out}) == 1


def test_pairs_of_seeds(spark):
    """Pairs of random places against a plain search."""
    rng = np.random.default_rng(26)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        th = np.sort(rng.integers(0, 3, n))
        x = np.concatenate([np.cumsum(rng.integers(1, int(rng.integers(2, 20)), (th == t).sum())) for t in range(3)])
        seed, many = rng.integers(1, int(rng.integers(2, 12)), n), rng.integers(0, 2, n).astype(bool)
        reach = rng.integers(0, 100, n)
        *_, h, a, b, still = passages.seed_pairs(th, x, seed, many, reach)
        pairs = []
        for i in range(n):
            for j in range(i + 1, n):
                far = x[j] - x[i]
                if th[i] != th[j] or far > passages.REACH or seed[j] in seed[i + 1:j] or seed[i] in seed[i + 1:j]:
                    continue
                if (many[i] or many[j]) and far >= passages.CHAIN - passages.K and (seed[i] != seed[j] or far > passages.K):
                    pairs.append((th[i], x[i], x[j], reach[i] < x[j] + passages.K))
        assert sorted(zip(h.tolist(), a.tolist(), b.tolist(), still.tolist())) == sorted(
            (int(t), int(p), int(q), bool(o)) for t, p, q, o in pairs)


def test_passages_with_other_words_between(spark):
    rng = np.random.default_rng(12)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1_000_000, n)]

    rows, wanted = [], set()
    # Words of each passage, and of what stands between in the one and in the other text.
    for passage, gap, other_gap, many in ((60, 120, 120, 2), (60, 120, 150, 2), (55, 52, 52, 4), (60, 100, 70, 3)):
        shared, n = [words(passage) for _ in range(many)], len(rows)
        for doc, between in ((n, gap), (n + 1, other_gap)):
            text, found = words(20), []
            for part in shared:
                found.append((doc, len(text), len(text) + passage))
                text += part + words(between)
            rows.append((doc, " ".join(text)))
            wanted |= set(found)
    out = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r.doc_id, r.start, r.stop) for r in out}
    # Passages with few words between may be one stretch.
    assert all(any(doc == d and x <= start and stop <= y for d, x, y in found) for doc, start, stop in wanted)
    assert {f for f in found if f[0] not in (4, 5)} == {w for w in wanted if w[0] not in (4, 5)}
    assert all(r.score == 1 or r.doc_id in (4, 5) and r.score >= 1 / 3 for r in out)


def test_alignments_side_by_side(monkeypatch):
    rng = np.random.default_rng(8)
    tasks = []
    for _ in range(60):
        a, b = (rng.integers(0, 4, rng.integers(0, 30)) for _ in range(2))
        tasks.append((a, b, int(rng.integers(-6, 7)), int(rng.integers(1, 12))))
    for many in (1, 7, 256):
        monkeypatch.setattr(passages, "SIDE_BY_SIDE", many)
        for (a, b, shift, band), (score, xs, xe, ys, ye) in zip(tasks, passages.stretches_of(tasks), strict=True):
            cells = {}
            for i in range(len(a)):
                for j in range(max(0, i + shift - band), min(len(b), i + shift + band + 1)):
                    cells[i, j] = max(0, cells.get((i - 1, j - 1), 0) + (1 if a[i] == b[j] else -1),
                                      cells.get((i - 1, j), 0) - 1, cells.get((i, j - 1), 0) - 1)
            assert score == max(cells.values(), default=0)
            assert not score or cells[xe - 1, ye - 1] == score and a[xs] == b[ys] and a[xe - 1] == b[ye - 1]


def test_chains_against_all_orders():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(2, 9))
        x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
        best = 0.0
        for mask in range(1, 1 << n):
            part = sorted((int(x[i]), int(y[i])) for i in range(n) if mask >> i & 1)
            steps = list(zip(part, part[1:], strict=False))
            if all(p[0] < q[0] and p[1] < q[1] for p, q in steps):
                best = max(best, passages.K + sum(min(passages.K, q[0] - p[0], q[1] - p[1])
                           - passages.GAP * (q[0] - p[0] + q[1] - p[1]) for p, q in steps))
        found = passages.chains(x, y)
        for chain in found:
            assert (np.diff(x[chain]) > 0).all() and (np.diff(y[chain]) > 0).all()
        if found and best > passages.CHAIN:
            chain = found[0]
            score = passages.K + sum(min(passages.K, b, d) - passages.GAP * (b + d) for b, d in zip(
                np.diff(x[chain]).tolist(), np.diff(y[chain]).tolist(), strict=True))
            assert score <= best + 1e-9


def test_leaks_query(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()}
    rows = decontaminate.op9_decontamination(spark, DIR).collect()
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        a, b = decontaminate.words_of(items[r.item_id]), decontaminate.words_of(texts[r.doc_id])[r.start:r.stop]
        assert plain_align(a, b) >= decontaminate.THRESHOLD * 2 * len(a)


def plain_align(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, rows[-1][j] + (2 if x == y else -1), rows[-1][j + 1] - 1, row[j] - 1))
        rows.append(row)
    return max(map(max, rows))


def test_leaks_with_edits_blocks_and_odd_rows(spark, odd, monkeypatch):
    rng = np.random.default_rng(6)
    items = [[f"w{i}" for i in rng.integers(0, 300, 40)] for _ in range(12)]
    edited = [w if i % 6 else "new" for i, w in enumerate(items[3])]
    docs = [(1, " ".join(items[0])), (2, "x y z " + " ".join(edited) + " tail"), (3, " ".join(f"v{i}" for i in range(50))), (4, "tiny")]
    bench = [(i, " ".join(w)) for i, w in enumerate(items)] + [(50, " ".join(items[0])), (51, "tiny"), (52, None), (53, ""), (None, "a b c")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(bench, "item_id long, text string")
    wanted = {(1, 0), (1, 50), (2, 3), (4, 51)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, tests).collect()} == wanted
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, tests).collect()} == wanted
    assert [r.doc_id for r in decontaminate.clean(frame, tests).collect()] == [3]
    assert decontaminate.clean(odd, tests.limit(0)).count() == odd.count()
    assert decontaminate.clean(odd, tests).columns == odd.columns
    assert decontaminate.leaks(odd.limit(0), tests).count() == 0


@pytest.mark.parametrize("every", [4, 5, 6])
def test_leaks_find_an_edited_copy_beside_exact_ones(spark, every, monkeypatch):
    rng = np.random.default_rng(every)
    item = [f"w{i}" for i in rng.integers(0, 5000, 40)]
    edited = [w if i % every else f"new{i}" for i, w in enumerate(item)]
    docs = [(i, " ".join(item)) for i in range(5)] + [(10 + i, f"a b {i} " + " ".join(edited)) for i in range(3)]
    # Runs that other documents hold alone, one a document.
    docs += [(20 + i, f"x{i} " + " ".join(item[p:p + 3]) + f" y{i}") for i, p in enumerate([1, 9, 17, 1, 1, 1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    wanted = {0, 1, 2, 3, 4, 10, 11, 12}
    assert {r.doc_id for r in decontaminate.leaks(frame, tests).collect()} == wanted
    monkeypatch.setattr(decontaminate, "FREQUENT_LEAST", 2)
    assert {r.doc_id for r in decontaminate.leaks(frame, tests).collect()} == wanted
    assert decontaminate.clean(frame, tests).count() == 6


def test_frequent_runs_are_those_that_stand_alone():
    item = [f"w{i}" for i in range(40)]
    items = decontaminate.Items.of([(1, " ".join(item))])
    row = {int(p): r for r, (_, p) in enumerate(items.places[3])}
    rare = items.only_rare({(3, row[p]): 101 for p in range(20)} | {(3, row[30]): 100}, 1000).rare[3]
    assert {p for p, r in row.items() if not rare[r]} == set(range(20))
    rare = items.only_rare({(3, row[p]): 101 + p for p in row}, 1000).rare[3]
    assert {p for p, r in row.items() if rare[r]} == set(range(decontaminate.LEAST_SEEDS))


def test_word_hashes_tell_words_apart_wherever_they_stand():
    from tapline.llm.common import word_hashes

    texts = ["ab cd", "", "ab", None, " cd  \u00e9\u00e9 ab ", " ", *(f"w{i} {i}x" for i in range(20_000))]
    column = pa.array(["left out", *texts])[1:]
    hashes, sizes = word_hashes(column)
    words = [(t or "").split() for t in texts]
    assert sizes.tolist() == [len(w) for w in words]
    by_word = dict(zip([w for row in words for w in row], hashes.tolist(), strict=True))
    assert len(set(by_word.values())) == len(by_word) and [by_word[w] for row in words for w in row] == hashes.tolist()
    assert [len(x) for x in word_hashes(pa.array([], pa.string()))] == [0, 0]
