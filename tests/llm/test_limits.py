"""What the operators leave on disk, and the work that they spare."""

import re
import time
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapline.llm import byte_bpe, line_dedup, passages, quality
from tapline.llm.common import staged
from tapline.session import scratch_root


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_staging_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key), shuffle_files(spark)
    dealt = spark.range(5000).repartition(4, "id").groupBy((F.col("id") % 70).alias("g")).count()
    rows = staged(dealt, "test")
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(key) == setting
    assert rows.count() == 70 and dealt.count() == 70


def test_lines_leave_one_staged_table(spark, documents):
    root = Path(scratch_root(spark).removeprefix("file:"))
    before = set(root.glob("tapline-*"))
    done = line_dedup.dedup_lines(documents.select("doc_id", "text"))
    assert {p.name.rsplit("-", 1)[0] for p in set(root.glob("tapline-*")) - before} == {"tapline-gone-lines"}
    assert done.count() == documents.count()


def test_replaced_words_need_no_matrix(monkeypatch):
    def refused(*_):
        raise AssertionError("an edit distance was computed")

    monkeypatch.setattr(line_dedup, "distance", refused)
    line = [f"w{i}" for i in range(20)]
    assert line_dedup.similar(line, ["x", *line[1:10], "y", *line[11:]], 0.8)


def test_verified_links_span_all_similar_pairs():
    rng = np.random.default_rng(4)
    lines, ends = [], []
    for size in [1, 2, 2, 3, 16, 17, 40, 5, 1]:
        base = rng.integers(0, 300, (3, 30))
        for _ in range(size):
            line = base[rng.integers(0, 3)].copy()
            line[rng.integers(0, 30, rng.integers(0, 8))] = rng.integers(0, 300)
            lines.append(" ".join(f"w{w}" for w in np.delete(line, rng.integers(0, 30, rng.integers(0, 3)))))
        ends.append(len(lines))
    fps = line_dedup.fingerprints(pa.array(lines))
    links = line_dedup.verified(pa.array(lines), fps, ends, 20, 0.8)
    wanted = [(i, j) for start, stop in zip([0, *ends], ends, strict=False) for i in range(start, stop) for j in range(start, i)
              if (int(fps[i]) ^ int(fps[j])).bit_count() <= 20
              and line_dedup.similar(lines[i].split(), lines[j].split(), 0.8)]

    def groups(pairs):
        name = list(range(len(lines)))
        for i, j in pairs:
            name = [name[j] if n == name[i] else n for n in name]
        return sorted(sorted(i for i, n in enumerate(name) if n == each) for each in set(name))

    assert groups(links) == groups(wanted) and len(wanted) > len(links) > 40
    assert len(links) == len(lines) - len(groups(wanted))


def plain_alignment(a, b, shift, band, price):
    """Score and ends of the best local alignment within the band, the earliest end in a, then in b."""
    best, row = (0, 0, 0), {}
    for i in range(len(a)):
        now = {}
        for k in range(2 * band + 1):
            j = i + shift - band + k
            equal = 0 <= j < len(b) and a[i] == b[j]
            now[k] = max(0, row.get(k, 0) + (1 if equal else -price), row.get(k + 1, 0) - price, now.get(k - 1, 0) - price)
        row = now
        k = max(row, key=lambda k: (row[k], -k))
        if row[k] > best[0]:
            best = (row[k], i + 1, i + 1 + shift - band + k)
    return best


def test_alignments_side_by_side_equal_plain_ones():
    rng = np.random.default_rng(6)
    for many in (3, 150):
        tasks = []
        for _ in range(many):
            x = rng.integers(0, 60, rng.integers(0, 40)).astype(np.int32)
            y = np.concatenate([rng.integers(0, 60, rng.integers(0, 8)), x[rng.random(len(x)) > 0.1]]).astype(np.int32)
            tasks.append((x, y, int(rng.integers(-3, 9)), int(rng.integers(4, 8))))
        for price in (1, 4, 1 << 20):
            got = passages.align_all(tasks, price)
            assert got.tolist() == [list(plain_alignment(*task, price)) for task in tasks]


def test_scoring_takes_little_room_beside_the_texts(texts):
    column = pa.array((list(texts.values()) * 20)[:4000])
    model = quality.Model(np.random.default_rng(3).random(1 << quality.BUCKET_BITS, np.float32), 0.1)
    assert column.nbytes > 2 << 20
    tracemalloc.start()
    scores = quality.probabilities(column, model)
    room = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert room < 30 << 20
    assert scores.to_pylist() == [quality.probabilities(column[i:i + 1], model)[0].as_py() for i in range(len(column))]


def test_coded_texts_go_back_piece_by_piece(texts):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_multi_50k.tiktoken")
    column = pa.array([None, "", *(list(texts.values()) * 5)[:1000]])
    pieces = list(byte_bpe.transcoded(column, byte_bpe.load(path, public.PATTERN), byte_bpe.load_decoder(path)))
    assert max(p.nbytes for p in pieces) < 2 << 20 < sum(p.nbytes for p in pieces)
    assert [x["decoded"].decode() for p in pieces for x in p.to_pylist()] == [x or "" for x in column.to_pylist()]


def test_distances_side_by_side():
    rng = np.random.default_rng(12)
    lines = [rng.integers(0, 6, n).tolist() for n in rng.integers(1, 40, 400)]
    counts = np.array([len(x) for x in lines])
    at, to = rng.integers(0, 400, (2, 6000))
    most = rng.integers(0, 12, 6000)
    fair = np.abs(counts[at] - counts[to]) <= most
    at, to, most = at[fair], to[fair], most[fair]
    found = line_dedup.within(np.concatenate(lines).astype(np.uint64), np.cumsum(counts) - counts, counts, at, to, most)
    assert 0.1 < found.mean() < 0.9
    assert found.tolist() == [line_dedup.distance(lines[i], lines[j], k) <= k for i, j, k in zip(at, to, most, strict=True)]


def test_short_lines_are_not_compared_one_by_one(monkeypatch):
    rng = np.random.default_rng(13)
    lines = []
    for _ in range(300):
        words = [f"w{i}" for i in rng.integers(0, 10_000, 40)]
        lines += [" ".join(words), " ".join(words[1:20] + ["new"] + words[20:])]
    ends = list(range(2, 601, 2))
    fps, asked = line_dedup.fingerprints(pa.array(lines)), []
    monkeypatch.setattr(line_dedup, "similar", lambda *pair: asked.append(pair))
    links = line_dedup.verified(pa.array(lines), fps, ends, 64, 0.8)
    assert sorted(map(sorted, links)) == [[i, i + 1] for i in range(0, 600, 2)] and not asked
    # Longer lines still are.
    line_dedup.verified(pa.array([" ".join(f"w{i}" for i in range(k, 600)) for k in (0, 1)]), np.zeros(2, np.uint64), [2], 64, 0.8)
    assert len(asked) == 1


def test_lines_of_texts_have_the_normal_form():
    texts = ["One two,  THREE 12\n\n  \nÉté—ñandú 日本語 ½ x_y", "", "one two three 34", "ΣΑΣ\nσας straße İx"] * 3
    rows = [x for part in line_dedup.signatures(pa.array(texts)) for x in part.to_pylist()]
    plain = [[(n, norm) for n, line in enumerate(text.split("\n")) if (norm := re.sub(
        "[0-9]", "0", re.sub(r"[\W_]+", " ", line.lower())).strip(" "))] for text in texts]
    assert [[x["no"] for x in row] for row in rows] == [[n for n, _ in row] for row in plain]
    hashes = {}
    for row, norms in zip(rows, plain, strict=True):
        for x, (_, norm) in zip(row, norms, strict=True):
            assert hashes.setdefault(norm, x["h"]) == x["h"] and x["words"] == len(norm.split())
    assert len(set(hashes.values())) == len(hashes)


def test_places_move_packed(spark):
    rng = np.random.default_rng(14)
    nodes = spark.createDataFrame(
        [(int(fp), rng.integers(0, 50, line_dedup.BANDS, np.uint32).tobytes(), 9) for fp in rng.integers(0, 1 << 40, 3000)],
        "fp long, keys binary, words int").repartition(2)
    masks = line_dedup.block_masks(3000, 3)
    plan = line_dedup.bucket_sets(nodes, masks, 3000, 64, 0.8)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
    # Every two lines that share a key hang together.
    found = {}
    for r in line_dedup.bucket_sets(nodes, masks, 3000, 64, 0.0).collect():
        found.setdefault(r.set, set()).add(r.fp)
    keys = {r.fp: np.frombuffer(bytes(r["keys"]), np.uint32) for r in nodes.collect()}
    wanted = {}
    for fp, key in keys.items():
        for band, k in enumerate(key.tolist()):
            wanted.setdefault((band, k), set()).add(fp)
    wide = [s for s in wanted.values() if all(bin(a ^ b).count("1") <= 64 for a in list(s)[:1] for b in s)]
    assert len(wide) == 50 * line_dedup.BANDS and all(s in found.values() for s in wide)


def test_lines_are_found_by_their_bytes():
    rng = np.random.default_rng(15)
    texts = ["".join(rng.choice(["a", "é", " ", "\n", "b1", "\n\n", "a word of more than 16 bytes: ñandúñandúñandú"], rng.integers(0, 12)))
             for _ in range(400)]
    rows = [x for part in line_dedup.signatures(pa.array(texts)) for x in part.to_pylist()]
    hashes = {}
    for text, row in zip(texts, rows, strict=True):
        for x in row:
            line = text.encode()[x["start"]:x["start"] + x["size"]].decode()
            assert line == text.split("\n")[x["no"]]
            norm = " ".join(re.sub("[0-9]", "0", re.sub(r"[\W_]+", " ", line)).split())
            assert hashes.setdefault(norm, x["h"]) == x["h"]
    assert len(set(hashes.values())) == len(hashes) > 20


def test_pairs_of_several_sets_are_looked_at_once(monkeypatch):
    rng, asked, plain = np.random.default_rng(16), [], line_dedup.within
    base = rng.integers(0, 1 << 64, 40, np.uint64)
    lines = [np.delete(base, i) for i in range(3)] + [np.delete(base, [3, 4]), np.append(base, base[:1])]
    counts, fps = np.array([len(x) for x in lines]), np.zeros(5, np.uint64)

    def counted(*args):
        asked.append(len(args[3]))
        return plain(*args)

    monkeypatch.setattr(line_dedup, "within", counted)
    once = line_dedup.spanning_links(np.concatenate(lines), counts, fps, [5], 20, 0.8)
    alone = sum(asked)
    asked.clear()
    # Three sets of the same lines, and one that holds some of them.
    again = line_dedup.spanning_links(np.concatenate(lines), counts, fps, [5, 10, 13, 18], 20, 0.8,
                                      np.array([*range(5), *range(5), 0, 2, 4, *range(5)]))
    assert once == again and len(once) == 4 and sum(asked) == alone


def test_distances_of_long_lines_side_by_side():
    rng = np.random.default_rng(17)
    lines = []
    for _ in range(60):
        line = rng.integers(0, 50, rng.integers(150, 400))
        lines += [line.tolist(), line[rng.random(len(line)) > 0.3].tolist()]
    counts, at = np.array([len(x) for x in lines]), np.arange(0, 120, 2)
    most = (counts[at] * rng.uniform(0.2, 0.5, len(at))).astype(int)
    at, most = at[counts[at] - counts[at + 1] <= most], most[counts[at] - counts[at + 1] <= most]
    args = np.concatenate(lines).astype(np.uint64), np.cumsum(counts) - counts, counts
    wanted = [line_dedup.distance(lines[i], lines[i + 1], int(k)) <= k for i, k in zip(at, most, strict=True)]
    assert line_dedup.within(*args, at, at + 1, most).tolist() == line_dedup.within(*args, at + 1, at, most).tolist() == wanted
    assert most.max() > 128


def test_many_pairs_are_united_at_once():
    rng = np.random.default_rng(18)
    for _ in range(100):
        n = int(rng.integers(1, 40))
        at, to = rng.integers(0, n, (2, int(rng.integers(0, 40))))
        root, wanted = np.arange(n), list(range(n))
        line_dedup.unite(root, at, to)
        for i, j in zip(at.tolist(), to.tolist(), strict=True):
            wanted = [max(wanted[i], wanted[j]) if w in (wanted[i], wanted[j]) else w for w in wanted]
        assert root.tolist() == wanted


def test_large_sets_with_one_least_line_are_parted(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SET_LINES", 100)
    rows = [(s, h) for s in range(40) for h in [7, *range(1000 + s, 1060 + s)]] + [(s, h) for s in (90, 91) for h in (5, 6)]
    rows += [(80, h) for h in range(2000, 2250)]
    found = {r.set: r for r in line_dedup.sets_with_company(spark.createDataFrame(rows, "set long, h long")).collect()}
    assert len(found) == 43 and {found[s].least for s in range(40)} == {7} and found[80].parts == 3
    together = np.bincount([found[s].slot for s in range(40)])
    assert 61 * together.max() <= 2 * 100 and found[90].slot == found[91].slot == 0 and found[90].parts == 1
